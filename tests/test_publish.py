"""A publish that stops after any step leaves the old table or the new one."""

import pytest
from pyspark.sql import functions as F

from ratetide.sinks import merge_upsert, publish
from ratetide.sinks.writers import write_partitioned

KIND = "month int, k string, n int"
OLD = [(1, "a", 1), (2, "b", 2), (2, "c", 3), (3, "d", 4), (None, "e", 5)]
DELTA = [(2, "b", 20), (4, "x", 9), (None, "e", 50)]
NEW = [(1, "a", 1), (2, "b", 20), (2, "c", 3), (3, "d", 4), (4, "x", 9), (None, "e", 50)]


class Lost(Exception):
    pass


def stop_after(monkeypatch, steps):
    """Let so many changes of the file system through, then lose the driver."""
    left = [steps]
    for name in ("_remove", "_move", "_record"):
        whole = getattr(publish, name)

        def step(*a, whole=whole):
            if not left[0]:
                raise Lost
            left[0] -= 1
            return whole(*a)

        monkeypatch.setattr(publish, name, step)


def rows(spark, path):
    return sorted(map(str, map(tuple, spark.read.parquet(path).select("month", "k", "n").collect())))


def want(table):
    return sorted(map(str, table))


@pytest.mark.parametrize("steps", range(0, 16, 2))
def test_upsert_lost_at_any_step(spark, tmp_dir, monkeypatch, steps):
    path = f"{tmp_dir}/t"
    write_partitioned(spark.createDataFrame(OLD, KIND), path, "month")
    delta = spark.createDataFrame(DELTA, KIND)
    with monkeypatch.context() as m:
        stop_after(m, steps)
        try:
            merge_upsert(spark, path, delta, ["month", "k"])
        except Lost:
            pass
    publish.recover(spark, path)
    assert rows(spark, path) in (want(OLD), want(NEW))
    publish.recover(spark, path)  # again: nothing to do
    merge_upsert(spark, path, delta, ["month", "k"])
    assert rows(spark, path) == want(NEW)
    import os
    assert os.listdir(tmp_dir) == ["t"]


@pytest.mark.parametrize("steps", range(0, 10))
def test_table_lost_at_any_step(spark, tmp_dir, monkeypatch, steps):
    path = f"{tmp_dir}/t"
    write_partitioned(spark.createDataFrame(OLD, KIND), path, "month")
    new = spark.read.parquet(path).withColumn("n", F.col("n") * 2).coalesce(1)
    with monkeypatch.context() as m:
        stop_after(m, steps)
        try:
            publish.publish_table(spark, new, path, "month")
        except Lost:
            pass
    publish.recover(spark, path)
    assert rows(spark, path) in (want(OLD), want([(a, b, 2 * c) for a, b, c in OLD]))


def test_partitions_that_became_empty_go(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    write_partitioned(spark.createDataFrame(OLD, KIND), path, "month")
    publish.publish_partitions(spark, spark.createDataFrame([(2, "z", 7)], KIND), path, "month", drop=[2, 3])
    assert rows(spark, path) == want([(1, "a", 1), (2, "z", 7), (None, "e", 5)])
