"""The pipeline's stages and run() against a brute-force version."""

import brute
import corpus_pipeline as P
import numpy as np
import pytest
from conftest import SF

from ratetide.llm import queries


def stages_by_force(docs, items):
    """[(id, text)] after each of the first four stages."""
    docs = [(i, t) for i, t in docs if brute.quality_kept(t)]
    yield docs
    groups = brute.components([brute.simhash(t) for _, t in docs])
    best = {}
    for (i, t), g in zip(docs, groups, strict=True):
        best[g] = min(best.get(g, (i, t)), (i, t))
    docs = sorted(best.values())
    yield docs
    docs = [(i, brute.kept_text(raw, gone)) for (i, _), (raw, gone) in zip(docs, brute.remove_repeats(docs), strict=True)]
    yield docs
    hits = brute.decontaminate(docs, items)
    yield [d for d, (n, hit, _) in zip(docs, hits, strict=True) if not (hit and 20 * len(hit) >= n)]


def test_run(spark):
    from tokenizers import Tokenizer

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    *_, want = stages_by_force(docs, items)
    library = Tokenizer.from_file(queries.vocabulary())
    got = P.run(spark, SF).collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted(want)
    for r in got:
        assert r.n_chars == len(r.text) and r.round_trip
        assert np.frombuffer(bytes(r.token_ids), "<u4").tolist() == library.encode(r.text, add_special_tokens=False).ids
        assert r.n_tokens == len(r.token_ids) // 4


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_stage_takes_any_documents(spark, clashing, no_docs, name):
    stage = dict(P.STAGES)[name]
    for docs in (clashing, no_docs):
        out = stage(spark, docs, SF)
        assert out.columns[:len(docs.columns)] == docs.columns
        assert name == P.STAGES[-1][0] or out.columns == docs.columns
        assert out.count() <= docs.count()


def test_stages_are_the_asked_ones():
    assert [n for n, _ in P.STAGES] == ["quality_rules", "simhash_near_dedup", "suffix_array_dedup",
                                        "benchmark_decontamination", "bpe_tokens"]
