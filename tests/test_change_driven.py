"""Version ledger and change-driven marts: what is read, what is written, and what survives a lost run."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ratetide.operators.prefilter import semi_join_few
from ratetide.plans import changed, ledger, marts, rates, runner, staging
from ratetide.sources.files import TRANSACTION_COLUMNS

TAIL = [c for c in TRANSACTION_COLUMNS if c not in ("transaction_id", "price", "transaction_date")]
KIND = "transaction_id string, price bigint, transaction_date string, " + ", ".join(f"{c} string" for c in TAIL)


def land(spark, root, day, rows):
    """Land (id, price, date, status) rows as the run_date folder of a day; all landed rows."""
    full = [(i, p, d, "P", "D", "N", "F", "1", None, "s", None, "t", "d", "KENT", "A", s) for i, p, d, s in rows]
    spark.createDataFrame(full, KIND).coalesce(2).write.parquet(f"{root}/run_date={day}")
    return spark.read.schema(f"{KIND}, run_date string").parquet(root)


def rows_of(df):
    return sorted(map(str, map(tuple, df.collect())))


def files(path):
    return {d: sorted((f, os.path.getmtime(f"{path}/{d}/{f}")) for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet"))
            for d in os.listdir(path) if "=" in d}


BATCHES = [
    ("2024-01-31", [("a", 1, "2020-01-05", "A"), ("b", 2, "2020-02-05", "A"), ("c", 3, "2020-03-05", "A"), ("d", 4, "2020-04-05", "A"),
                    ("e", 5, "2021-06-05", "A"), (None, 6, "2020-05-01", "A"), ("gone", 7, "2020-08-01", "A")]),
    ("2024-02-29", [("old", 7, "2018-03-01", "A"), ("b", 2, "2020-02-05", "D"), ("c", 30, "2020-03-05", "A"), ("d", 40, "2020-07-01", "A"),
                    (None, 60, "2020-05-01", "A"), ("gone", 7, "2020-08-01", "D"), ("e", 5, "2019-01-01", "A")]),
    ("2024-03-31", [("b", 2, "2020-02-05", "A"), ("gone", 8, "2020-09-01", "A"), ("d", 40, "2020-07-01", "D"), ("never", 1, "2020-09-02", "D")]),
]


def test_three_loads_equal_full_restages(spark, tmp_dir):
    path, landed = f"{tmp_dir}/stg", f"{tmp_dir}/raw"
    for day, rows in BATCHES:
        raw = land(spark, landed, day, rows)
        before = files(path) if os.path.exists(path) else {}
        touched = ledger.load_versions(spark, raw, path)
        got = spark.read.parquet(path)
        full = staging.stg_transactions(raw)
        assert rows_of(got.select(*full.columns)) == rows_of(full)
        if touched is not None:
            kept = {d: f for d, f in before.items() if dt.date.fromisoformat(d.split("=")[1]) not in touched}
            assert kept and all(files(path)[d] == f for d, f in kept.items())
        assert ledger.VersionLedger(spark, f"{path}__versions").mark() == day
    assert touched == [dt.date(2020, m, 1) for m in (2, 7, 9)]
    before = files(path)
    assert ledger.load_versions(spark, raw, path) == [] and files(path) == before  # nothing new


def test_only_new_folders_are_read_and_nothing_whole_is_shuffled(spark, tmp_dir):
    path, landed = f"{tmp_dir}/stg", f"{tmp_dir}/raw"
    for day, rows in BATCHES[:2]:
        ledger.load_versions(spark, land(spark, landed, day, rows), path)
    raw = land(spark, landed, *BATCHES[2])
    book = ledger.VersionLedger(spark, f"{path}__versions")
    unread = book.unread(raw)
    plan = spark._jvm.PythonSQLUtils.explainString(unread._jdf.queryExecution(), "formatted")
    pruned = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "run_date" in pruned and "2024-02-29" in pruned
    assert unread.count() == len(BATCHES[2][1])
    # the ledger is met by a broadcast bitmap before any exchange
    found = semi_join_few(book.versions(), unread.select("transaction_id"), "transaction_id")
    text = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    exact = next(i for i, x in enumerate(text) if "<=>" in x)
    bitmap = next(i for i, x in enumerate(text) if "getbit" in x)
    assert "rightHint=(strategy=broadcast)" in text[bitmap]
    assert exact < bitmap < next(i for i, x in enumerate(text) if "record_status" in x and "Relation" in x)
    assert {r.transaction_id for r in found.collect()} == {"b", "gone", "d"}


@pytest.mark.parametrize("max_bits", [1 << 28, 32768])
def test_semi_join_few(spark, max_bits):
    df = spark.range(50_000).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit("x").alias("v"))
    keys = spark.createDataFrame([(k,) for k in [None, 7, 7, 49_999, 60_000, *range(100, 9_000)]], "k long")
    got = semi_join_few(df, keys, "k", max_bits)
    assert got.columns == ["k", "v"]
    assert {r.k for r in got.collect()} == {None, 7, 49_999, *range(100, 9_000)} and got.count() == 8_903
    assert semi_join_few(df, keys.limit(0), "k").count() == 0


@pytest.mark.parametrize("step", ["write", "commit"])
def test_a_lost_load_is_done_again(spark, tmp_dir, monkeypatch, step):
    path, landed = f"{tmp_dir}/stg", f"{tmp_dir}/raw"
    ledger.load_versions(spark, land(spark, landed, *BATCHES[0]), path)
    raw = land(spark, landed, *BATCHES[1])
    with monkeypatch.context() as m:
        def lost(*a, **k):
            raise RuntimeError("lost")

        if step == "write":
            m.setattr(ledger, "publish_partitions", lost)
        else:
            m.setattr(ledger.VersionLedger, "commit", lost)
        with pytest.raises(RuntimeError):
            ledger.load_versions(spark, raw, path)
    noted = []
    ledger.load_versions(spark, raw, path, note=noted.append)
    full = staging.stg_transactions(raw)
    assert rows_of(spark.read.parquet(path).select(*full.columns)) == rows_of(full)
    assert noted and dt.date(2018, 3, 1) in noted[0]


def test_incomplete_generation_does_not_count(spark, tmp_dir):
    path, landed = f"{tmp_dir}/stg", f"{tmp_dir}/raw"
    ledger.load_versions(spark, land(spark, landed, *BATCHES[0]), path)
    book = ledger.VersionLedger(spark, f"{path}__versions")
    os.makedirs(f"{path}__versions/through=2030-01-01")
    assert book.mark() == "2024-01-31"


# ------------------------------------------------------------------- marts
def series(spark, revised=False):
    """Raw rates, rate events and yields of 2017 to 2021."""
    stamp = "2024-01-01 00:00:00"
    r = [(f"{y}-{m:02d}-01", 1.0 + y % 5 + m / 10) for y in range(2017, 2022) for m in (1, 6)]
    if revised:
        r = [(d, 9.0 if d == "2020-06-01" else v) for d, v in r]
    cast = lambda df: df.withColumn("loaded_at", F.lit(stamp).cast("timestamp"))
    raw_rates = cast(spark.createDataFrame(r, "d string, base_rate double").select(F.to_date("d").alias("effective_date"), "base_rate", F.lit("x").alias("source")))
    events = spark.createDataFrame([], "event_id string, effective_date date, previous_rate double, new_rate double, published_at timestamp")
    y = [(f"{y}-{m:02d}-{d:02d}", y - 2015 + m / 7 + d / 9) for y in range(2018, 2021) for m in range(1, 13) for d in (3, 17)]
    raw_yields = cast(spark.createDataFrame(y, "d string, yield_pct double").select(F.to_date("d").alias("date"), "yield_pct", F.lit("T").alias("ticker")))
    return {"rates": raw_rates, "rate_events": events, "yields": raw_yields}


def rebuilt(spark, raw):
    """Monthly and lag marts from scratch."""
    from ratetide.plans.graph import ModelGraph

    g = ModelGraph(spark, raw, min_months=1)
    return {"monthly_transactions_by_region": g.monthly_transactions_by_region, "rate_lag_analysis": g.rate_lag_analysis,
            "regional_sensitivity": g.regional_sensitivity}


def same_as_rebuilt(spark, out, raw):
    for name, want in rebuilt(spark, raw).items():
        got = spark.read.parquet(f"{out}/{name}")
        num = [f.name for f in want.schema if f.dataType.typeName() == "double"]
        want = want.select(*(F.round(c, 9).alias(c) if c in num else c for c in want.columns))
        got = got.select(*(F.round(c, 9).alias(c) if c in num else c for c in want.columns))
        assert rows_of(got) == rows_of(want), name


def run(spark, raw, out):
    runner.run_pipeline(spark, raw, out, check=False, change_driven=True, min_months=1)


def test_marts_follow_changes_of_any_age(spark, tmp_dir):
    out, landed = f"{tmp_dir}/out", f"{tmp_dir}/raw"
    base = series(spark)
    lag, mart = f"{out}/rate_lag_analysis", f"{out}/monthly_transactions_by_region"
    for day, rows in BATCHES:
        raw = base | {"transactions": land(spark, landed, day, rows)}
        before = {p: files(p) for p in (lag, mart) if os.path.exists(p)}
        run(spark, raw, out)
        same_as_rebuilt(spark, out, raw)
        if day == "2024-03-31":  # February, July and September 2020 changed; lags reach half a year on
            months = {p: {d.split("=")[1] for d in set(files(p)) if files(p)[d] == before[p].get(d)} for p in before}
            assert months[mart] == {"2018-03-01", "2020-01-01", "2020-03-01", "2020-05-01", "2021-06-01"}
            assert months[lag] == {"2018-03-01", "2020-01-01", "2021-06-01"}
    # a revised rate dirties the months that it governs, and no others
    raw |= series(spark, revised=True)
    before = files(mart)
    run(spark, raw, out)
    same_as_rebuilt(spark, out, raw)
    after = files(mart)
    assert {d.split("=")[1] for d in after if after[d] != before[d]} == {"2020-09-01"}
    before = {p: files(p) for p in (lag, mart)}
    run(spark, raw, out)  # nothing is new
    assert before == {p: files(p) for p in (lag, mart)}


@pytest.mark.parametrize("lost_in", ["monthly", "lag"])
def test_a_lost_refresh_is_taken_up(spark, tmp_dir, monkeypatch, lost_in):
    out, landed = f"{tmp_dir}/out", f"{tmp_dir}/raw"
    base = series(spark)
    run(spark, base | {"transactions": land(spark, landed, *BATCHES[0])}, out)
    raw = base | {"transactions": land(spark, landed, *BATCHES[1])}
    with monkeypatch.context() as m:
        def lost(*a):
            raise RuntimeError("lost")

        m.setattr(changed.MartRefresh, lost_in, lost)
        with pytest.raises(RuntimeError):
            run(spark, raw, out)
    run(spark, raw, out)
    same_as_rebuilt(spark, out, raw)


def test_add_months():
    assert changed.add_months(dt.date(2020, 11, 1), 3) == dt.date(2021, 2, 1)
    assert changed.add_months(dt.date(2020, 1, 1), -1) == dt.date(2019, 12, 1)
    assert marts.MONTHLY_COLUMNS[0] == "month" and rates.rate_for_month
