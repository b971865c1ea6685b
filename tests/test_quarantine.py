"""Row-level quarantine: marks, splits, and runs that set bad rows aside."""

import pytest
from pyspark.sql import functions as F

from ratetide.plans.runner import run_pipeline
from ratetide.quality import checks as Q
from ratetide.quality.quarantine import mark_rows, split_rows
from test_change_driven import land, rows_of

KIND = "id string, price bigint, note string"
ROWS = [("a", 1, "x"), ("a", 1, "x"), ("b", None, "y"), (None, 5, "x"), (None, 50, None), ("c", 2, "x"), ("d", 99, "")]
CHECKS = [Q.Unique("id"), Q.NotNull("price"), Q.AcceptedRange("price", 0, 10), Q.RowCountBetween(None, 100, None),
          Q.NotNull("note", severity="warn"), Q.Between("price", 5, 99, mostly=0.1)]


def test_marks_follow_run_checks(spark):
    df = spark.createDataFrame(ROWS, KIND)
    marked = mark_rows(df, CHECKS)
    assert marked.columns == [*df.columns, "failed_checks"] and marked.count() == len(ROWS)
    counts = {r[0]: r[1] for r in marked.select(F.explode("failed_checks").alias("c")).groupBy("c").count().collect()}
    told = {f"{r.check}({r.column})": r.failed for r in Q.run_checks(df, CHECKS).collect() if r.check != "row_count_between"}
    assert counts == {c: n for c, n in told.items() if n}


def test_split_keeps_every_row_once(spark):
    df = spark.createDataFrame(ROWS, KIND)
    good, bad = split_rows(df, CHECKS)
    assert rows_of(good) == rows_of(spark.createDataFrame([ROWS[3], ROWS[5]], KIND))
    found = sorted((str(r.id), tuple(r.failed_checks)) for r in bad.collect())
    assert found == [("None", ("accepted_range(price)",)), ("a", ("unique(id)",)), ("a", ("unique(id)",)),
                     ("b", ("not_null(price)",)), ("d", ("accepted_range(price)",))]


def test_empty_frames_no_checks_and_clashing_names(spark):
    empty = spark.createDataFrame([], KIND)
    assert [x.count() for x in split_rows(empty, CHECKS)] == [0, 0]
    df = spark.createDataFrame(ROWS, KIND)
    assert split_rows(df, [])[0].count() == len(ROWS)
    assert mark_rows(df.withColumn("_n", F.lit(1)), [Q.Unique("_n")]).filter("size(failed_checks) = 1").count() == len(ROWS)
    with pytest.raises(ValueError):
        mark_rows(df.withColumn("failed_checks", F.lit(1)), CHECKS)


def test_hot_duplicate_is_not_gathered(spark):
    """A third of the rows hold one id; rows of other ids are not shuffled for the marks."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"))
    good, bad = split_rows(df, [Q.Unique("id")])
    assert good.count() == 20_000 and bad.count() == 10_000
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert "getbit" in plan and "LeftAnti" not in plan  # the bitmap comes first


def test_runs_set_raw_rows_aside(spark, tmp_dir):
    suites = {"transactions": [Q.NotNull("transaction_id"), Q.AcceptedRange("price", 1, 1000), Q.RowCountBetween(None, 1, None)]}
    days = [("2024-01-31", [("a", 1, "2020-01-05", "A"), ("b", 0, "2020-02-05", "A"), (None, 5, "2020-02-06", "A")]),
            ("2024-02-29", [("a", 5000, "2020-03-05", "A"), ("c", 7, "2020-03-06", "A")])]
    out = f"{tmp_dir}/out"
    for day, rows in days:
        raw = land(spark, f"{tmp_dir}/raw", day, rows)
        res = run_pipeline(spark, {"transactions": raw}, out, targets=["stg_transactions"], raw_suites=suites,
                           on_failure="quarantine")
    got = spark.read.parquet(f"{out}/stg_transactions").select("transaction_id", "price")
    # the bad reload of a does not displace the good version before it
    assert rows_of(got) == ["('a', 1)", "('c', 7)"]
    bad = spark.read.parquet(res.quarantined["raw_transactions"])
    assert sorted((str(r.transaction_id), r.price, r.load, r.failed_checks[0]) for r in bad.collect()) == [
        ("None", 5, "first", "not_null(transaction_id)"), ("a", 5000, "2024-01-31", "accepted_range(price)"),
        ("b", 0, "first", "accepted_range(price)")]
    # a whole restage judges all landed rows and gives the same
    run_pipeline(spark, {"transactions": raw}, f"{tmp_dir}/again", targets=["stg_transactions"], raw_suites=suites,
                 on_failure="quarantine", incremental=False)
    assert rows_of(spark.read.parquet(f"{tmp_dir}/again/stg_transactions").select("transaction_id", "price")) == rows_of(got)


def test_runs_set_staged_rows_aside_and_raise_for_tables(spark, tmp_dir):
    raw = land(spark, f"{tmp_dir}/raw", "2024-01-31", [("a", 1, "2020-01-05", "A"), ("b", 0, "2020-02-05", "A")])
    res = run_pipeline(spark, {"transactions": raw}, f"{tmp_dir}/out", targets=["stg_transactions"], raw_suites={},
                       on_failure="quarantine")
    bad = spark.read.parquet(res.quarantined["stg_transactions"]).collect()
    assert [(r.transaction_id, r.failed_checks) for r in bad] == [("b", ["accepted_range(price)", "positive_prices(price)"])]
    with pytest.raises(Q.DataQualityError):
        run_pipeline(spark, {"transactions": raw}, f"{tmp_dir}/out2", targets=["stg_transactions"], on_failure="quarantine",
                     raw_suites={"transactions": [Q.RowCountBetween(None, 10, None)]})
    with pytest.raises(ValueError):
        run_pipeline(spark, {"transactions": raw}, f"{tmp_dir}/out3", targets=["stg_transactions"], on_failure="ignore")
