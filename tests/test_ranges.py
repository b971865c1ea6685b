"""Lag, lead and last value by ranges against the window of one task."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ratetide.operators.asof import asof_lookup, step_intervals
from ratetide.operators.changes import detect_changes
from ratetide.operators.ranges import OrderedRanges


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(11)
    rows = [(rng.choice([None, rng.randint(0, 40)]), i, rng.choice([None, None, rng.randint(0, 5)])) for i in range(400)]
    rows += [(7, i, None if i % 3 else i) for i in range(400, 800)]  # half of the rows at one place
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k int, id int, v int").repartition(5)


def same(got, want):
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.select(*got.columns).collect())))


@pytest.mark.parametrize("ranges", [1, 9])
def test_ranges(series, ranges):
    w = Window.orderBy(F.col("k").asc_nulls_first(), "id")
    dealt = OrderedRanges(series, ["k", "id"], ranges)
    assert dealt.rows.select("_range").distinct().count() >= min(ranges, 5)
    same(dealt.lag("v", "out"), series.withColumn("out", F.lag("v").over(w)))
    same(dealt.lead("v", "out"), series.withColumn("out", F.lead("v").over(w)))
    same(dealt.last_value("v", "out"), series.withColumn("out", F.last("v", ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow))))


def test_no_single_task_window_over_rows(series, spark):
    got = OrderedRanges(series, ["k", "id"], 6).lag("v", "out")
    text = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
    for part in text.split("Exchange\n")[1:]:
        # what one task orders is a row per range, not the rows
        if "SinglePartition" in part.split("\n\n")[0]:
            assert "_range" in part.split("\n\n")[0] and "id#" not in part.split("\n\n")[0]


def test_operators_take_ranges(spark, series):
    known = series.filter("k is not null and v is not null")
    one = known.groupBy("k").agg(F.max("v").alias("v"))
    same(detect_changes(one, "k", "v", ranges=4), detect_changes(one, "k", "v"))
    same(step_intervals(known, "k", ["id"], ranges=4), step_intervals(known, "k", ["id"]))
    probe = spark.createDataFrame([(x,) for x in (-1, 0, 3, 3, 7, 41, None)], "p int")
    for how in ("left", "inner"):
        same(asof_lookup(probe, "p", series, "k", "v", ["id"], how, ranges=5), asof_lookup(probe, "p", series, "k", "v", ["id"], how))


def test_empty(spark):
    none = spark.createDataFrame([], "k int, v int")
    assert OrderedRanges(none, ["k"]).lag("v", "out").collect() == []
    assert OrderedRanges(none, ["k"]).last_value("v", "out").collect() == []
