"""The staged and reconciled series of a run are worked out once, by a sort on their key only."""

import datetime as dt

from pyspark.sql import functions as F

from ratetide.operators.dedup import dedup_latest, dedup_latest_few
from ratetide.plans import runner, staging
from test_change_driven import BATCHES, land, series


def test_marts_read_written_series(spark, tmp_dir, monkeypatch):
    seen = {}

    class Spy(runner.MartRefresh):
        def __init__(self, spark, root, reconciled, yields, lags):
            seen.update(reconciled=reconciled, yields=yields)
            super().__init__(spark, root, reconciled, yields, lags)

    monkeypatch.setattr(runner, "MartRefresh", Spy)
    raw = series(spark) | {"transactions": land(spark, f"{tmp_dir}/raw", *BATCHES[0])}
    runner.run_pipeline(spark, raw, f"{tmp_dir}/out", targets=["rate_lag_analysis"], change_driven=True, on_failure="warn")
    for name, df in seen.items():
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in plan and "Aggregate" not in plan and "Relation" in plan, name
    want = staging.stg_yields(raw["yields"])
    assert sorted(map(tuple, seen["yields"].collect())) == sorted(map(tuple, want.collect()))


def test_latest_of_few_keys_is_that_of_the_window(spark):
    day = dt.date(2020, 1, 1)
    rows = [(d, v, t, s) for d in (day, None) for v in (1.0, float("nan"), None) for t in ("A", "B", None) for s in (1, 2, None)]
    rows += [(dt.date(2020, 1, 2), 1.0, "A", None), (dt.date(2020, 1, 2), None, "B", None), (dt.date(2020, 1, 3), None, None, None)]
    df = spark.createDataFrame(rows, "date date, yield_pct double, ticker string, loaded_at long").repartition(7)
    got, want = dedup_latest_few(df, ["date"], ["loaded_at"]), dedup_latest(df, ["date"], ["loaded_at"])
    assert got.schema == want.schema and got.count() == 4
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert "Window" not in staging.stg_yields(df.withColumn("loaded_at", F.col("loaded_at").cast("timestamp")))._jdf.queryExecution().optimizedPlan().toString()
