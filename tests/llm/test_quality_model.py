"""The classifier's sums, choice of labels and calibration."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratetide.llm import quality_model as qm


def test_sums_do_not_depend_on_attempts(spark):
    """The partial sums of a map task are the same rows whenever it runs."""
    docs = spark.range(400).select(F.concat_ws(" ", F.lit("word"), F.col("id") % 7, F.col("id") % 11, F.lit("end")).alias("text")).repartition(6)
    docs = spark.createDataFrame(docs.collect(), "text string").repartition(6, "text")
    s = qm.Settings()
    first, second = (qm.word_vectors(docs, "text", s) for _ in range(2))
    assert (first == second).all()
    other = qm.word_vectors(docs.coalesce(2), "text", s)
    assert np.allclose(first, other, atol=1e-5)


@pytest.mark.parametrize("most", [50, 5000])
def test_chosen_labels(spark, most):
    rows = [(i, i % 2) for i in range(3000)] + [(i, 1 - i % 2) for i in range(0, 3000, 3)] + [(None, 1), (7, None)]
    s = qm.Settings(max_rows=most)
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    got, again = ([tuple(r) for r in qm.chosen_labels(x, "doc_id", "quality", s).collect()] for x in (labels.repartition(9), labels.coalesce(1)))
    held = {r[0] for r in spark.range(3000).where(qm.held_out(F.col("id"))).collect()}
    want = {i for i in range(3000)} - held
    assert sorted(got) == sorted(again) and len({i for i, _ in got}) == len(got) == min(most, len(want))
    assert {i for i, _ in got} <= want and all(y == (0 if i % 3 == 0 else i % 2) for i, y in got)


def test_calibration():
    """Scores of unseen rows are the shares of label 1 among them."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(12_000, 6))
    p = 1 / (1 + np.exp(-1.5 * x[:, 0] - x[:, 1]))
    y = (rng.random(len(x)) < p).astype(float)
    net = qm.Network(x[:6000], y[:6000], qm.Settings())
    score = net.score(x[6000:])
    for a, b in ((0, 0.2), (0.2, 0.4), (0.4, 0.6), (0.6, 0.8), (0.8, 1.01)):
        rows = (score >= a) & (score < b)
        assert rows.sum() > 200 and abs(score[rows].mean() - y[6000:][rows].mean()) < 0.06
