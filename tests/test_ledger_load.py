"""What a load of the version ledger shuffles, writes and leaves behind."""

import os

import pytest
from pyspark.sql import functions as F

from ratetide.plans import ledger, staging
from ratetide.sinks.writers import _fs
from test_change_driven import BATCHES, land, rows_of


@pytest.mark.parametrize("few", [0, 1 << 40])
def test_loads_equal_full_restages_with_and_without_the_bitmap(spark, tmp_dir, monkeypatch, few):
    from ratetide.session import _scratch_root

    monkeypatch.setattr(ledger, "FEW", few)
    root = _scratch_root(spark).removeprefix("file:")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    path, landed = f"{tmp_dir}/stg", f"{tmp_dir}/raw"
    again = ("2024-04-30", [(None, 60, "2020-05-01", "A"), ("c", 30, "2020-03-05", "A"), ("c", 30, "2020-03-05", "D")])
    for day, rows in [*BATCHES, again]:
        raw = land(spark, landed, day, rows)
        ledger.load_versions(spark, raw, path)
        full = staging.stg_transactions(raw)
        assert rows_of(spark.read.parquet(path).select(*full.columns)) == rows_of(full)
    # the versions of a load are written once, as its generation
    assert (set(os.listdir(root)) if os.path.isdir(root) else set()) == before
    assert sorted(os.listdir(f"{path}__versions")) == [f"through={d}" for d, _ in [*BATCHES, again]]


def test_each_side_of_a_large_load_is_shuffled_once(spark, tmp_dir):
    path, landed = f"{tmp_dir}/stg", f"{tmp_dir}/raw"
    ledger.load_versions(spark, land(spark, landed, *BATCHES[0]), path)
    book = ledger.VersionLedger(spark, f"{path}__versions")
    unread = book.unread(land(spark, landed, *BATCHES[1]))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        changed = ledger._changed(unread, len(BATCHES[1][1]), book)
        text = changed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("Exchange hashpartitioning") == 2 and text.count("Exchange") == 2
    was = {r.transaction_id: r[ledger.BEFORE] for r in changed.collect()}
    assert was["old"] is None and "e" not in was and str(was["d"]) == "2020-04-01" and str(was[None]) == "2020-05-01"


def test_a_generation_moved_half_way_does_not_count(spark, tmp_dir):
    book = ledger.VersionLedger(spark, f"{tmp_dir}/versions")
    book.prepare(spark.range(3).withColumn("x", F.lit(1)))
    assert book.mark() is None  # prepared only
    book.commit("2024-01-31")
    assert book.mark() == "2024-01-31" and book.versions().count() == 3
    fs, mark = _fs(spark, f"{tmp_dir}/versions/through=2024-01-31/_SUCCESS")
    fs.delete(mark, False)
    assert book.mark() is None
    book.prepare(spark.range(2).withColumn("x", F.lit(1)))
    book.commit("2024-01-31")
    assert book.mark() == "2024-01-31" and book.versions().count() == 2
