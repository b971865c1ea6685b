"""Hand-made cases for the semantics that decide correctness (quirks Q1-Q23)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ratetide.functions.columns import normalize_key, property_type_label, safe_corr
from ratetide.functions.fixed_values import RATE_HISTORY, county_map_rows
from ratetide.operators import asof_lookup, calendar_lag, dedup_latest, detect_changes
from ratetide.plans import marts, rates, staging
from ratetide.sources.files import TRANSACTION_COLUMNS

D = dt.date


def raw_tx(spark, rows):
    """rows: dicts with a subset of the 16 raw columns (others NULL)."""
    full = [tuple(r.get(c) for c in TRANSACTION_COLUMNS) for r in rows]
    from ratetide.sources.files import TRANSACTION_SCHEMA

    return spark.createDataFrame(full, TRANSACTION_SCHEMA)


def tx(i, date, status="A", price=100, county="KENT", ptype="D", postcode="x"):
    return {"transaction_id": str(i), "price": price, "transaction_date": f"{date} 00:00",
            "record_status": status, "county": county, "property_type": ptype,
            "postcode": postcode}


def test_dedup_runs_before_status_filter(spark):
    df = raw_tx(spark, [tx(1, "2020-01-01", "A"), tx(1, "2020-02-01", "D"), tx(2, "2020-01-01")])
    out = staging.stg_transactions(df)
    assert sorted(r.transaction_id for r in out.collect()) == ["2"]


def test_reload_tie_broken_by_run_date(spark):
    df = raw_tx(spark, [tx(1, "2020-01-01", price=100), tx(1, "2020-01-01", price=110)])
    df = df.withColumn("run_date", F.when(F.col("price") == 110, "2").otherwise("1"))
    out = staging.stg_transactions(df).collect()
    assert [r.price for r in out] == [110]


def test_min_date_and_since_prefilter_commute(spark):
    rows = [tx(1, "1996-12-31"), tx(2, "1997-01-01"), tx(3, "2000-01-05"), tx(3, "1999-12-20"),
            tx(4, "1999-12-01")]
    df = raw_tx(spark, rows)
    full = {r.transaction_id for r in staging.stg_transactions(df)
            .filter(F.col("transaction_date") >= D(2000, 1, 1)).collect()}
    pre = {r.transaction_id for r in staging.stg_transactions(df, since="2000-01-01").collect()}
    assert full == pre == {"3"}
    assert {r.transaction_id for r in staging.stg_transactions(df).collect()} == {"2", "3", "4"}


def test_county_normalisation_and_null_county(spark):
    df = raw_tx(spark, [tx(1, "2020-01-01", county=" kent\t", postcode=" sw1a 1aa "),
                        tx(2, "2020-01-01", county=None), tx(3, "2020-01-01", county="Nowhere")])
    out = {r.transaction_id: r for r in staging.stg_transactions(df).collect()}
    assert out["1"].broad_region == "South East" and out["1"].region == " kent\t"
    assert out["1"].postcode == "SW1A 1AA"
    assert out["2"].region is None and out["2"].broad_region == "Other England"
    assert out["3"].broad_region == "Other England"


def test_county_map_fixed_values():
    rows = county_map_rows()
    assert len(rows) == 116
    assert len({r for _, r in rows}) == 10
    assert ("BOURNEMOUTH, CHRISTCHURCH AND POOLE", "South West") in rows


def test_property_label_without_else(spark):
    df = spark.createDataFrame([("D",), ("X",), (None,)], "t string")
    got = {r.t: r.l for r in df.select("t", property_type_label("t").alias("l")).collect()}
    assert got == {"D": "Detached", "X": None, None: None}


def test_normalize_strips_tabs(spark):
    df = spark.createDataFrame([("\t a b \n",)], "s string")
    assert df.select(normalize_key("s")).first()[0] == "A B"


def _rates(spark, rows):
    df = spark.createDataFrame([(D.fromisoformat(d), r) for d, r in rows],
                               "effective_date date, base_rate double")
    return df.withColumn("effective_month", F.trunc("effective_date", "MM"))


def test_two_changes_in_one_month_both_asof_forms(spark):
    r = _rates(spark, [("2020-03-11", 0.25), ("2020-03-19", 0.10), ("2020-01-05", 0.75)])
    months = spark.createDataFrame([(D(2020, 3, 1),), (D(2020, 2, 1),), (D(2019, 12, 1),)],
                                   "m date")
    left = {x.m: x.base_rate for x in rates.rate_for_month(months, "m", r).collect()}
    inner = {x.m: x.base_rate for x in rates.rate_for_month(months, "m", r, "inner").collect()}
    assert left == {D(2020, 3, 1): 0.10, D(2020, 2, 1): 0.75, D(2019, 12, 1): None}
    assert inner == {D(2020, 3, 1): 0.10, D(2020, 2, 1): 0.75}


def test_asof_carries_null_values_and_partitions(spark):
    s = spark.createDataFrame([("a", 1, 10.0), ("a", 3, None), ("b", 2, 7.0)],
                              "k string, t int, v double")
    p = spark.createDataFrame([("a", 2), ("a", 4), ("b", 1), ("b", 5)], "k string, t int")
    got = {(x.k, x.t): x.v for x in asof_lookup(p, "t", s, "t", "v", partition_by=["k"])
           .collect()}
    assert got == {("a", 2): 10.0, ("a", 4): None, ("b", 1): None, ("b", 5): 7.0}


def test_streaming_beats_batch_and_priority_dedup(spark):
    b = spark.createDataFrame([(D(2024, 8, 1), 5.0, "x", None)],
                              "effective_date date, base_rate double, source string, "
                              "loaded_at timestamp")
    s = spark.createDataFrame([("e1", D(2024, 8, 1), None, 4.9, None)],
                              "event_id string, effective_date date, previous_rate double, "
                              "new_rate double, published_at timestamp")
    out = rates.int_rates_reconciled(b, s).collect()
    assert [(r.base_rate, r.source_type) for r in out] == [(4.9, "streaming")]


def test_rate_range_filter(spark):
    raw = spark.createDataFrame([(D(2024, 1, 1), 20.0), (D(2024, 1, 2), 20.01),
                                 (D(2024, 1, 3), None)], "effective_date date, base_rate double")
    raw = raw.withColumn("source", F.lit("s")).withColumn("loaded_at", F.current_timestamp())
    assert [r.base_rate for r in staging.stg_rates(raw).collect()] == [20.0]


def test_golden_rate_history(spark):
    h = rates.rate_history(spark)
    assert h.count() == 69
    assert h.select("effective_month").distinct().count() == 68
    rec = h.withColumn("source_type", F.lit("batch"))
    ev = rates.rate_change_events(rec).collect()
    assert len(ev) == 66
    assert sum(r.direction == "hike" for r in ev) == 31
    assert sum(r.direction == "cut" for r in ev) == 35
    assert len(RATE_HISTORY) - 1 - len(ev) == 2  # two holds


def test_first_run_change_detection(spark):
    s = _rates(spark, [("2024-01-01", 3.75), ("2024-02-01", 3.75), ("2024-03-01", 4.0)])
    out = detect_changes(s, "effective_date", "base_rate").orderBy("effective_date").collect()
    assert [(r.base_rate, r.previous_rate) for r in out] == [(3.75, None), (4.0, 3.75)]


def test_calendar_lag_missing_month(spark):
    df = spark.createDataFrame([(D(2020, 1, 1), 1.0), (D(2020, 2, 1), 2.0), (D(2020, 4, 1), 4.0)],
                               "month date, v double")
    got = {r.month: r for r in calendar_lag(df, "month", "v", (1, 2)).collect()}
    assert got[D(2020, 4, 1)].lag_1m is None and got[D(2020, 4, 1)].lag_2m == 2.0


def test_safe_corr_constant_is_null(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.0, 2.0), (0.0, 3.0)], "x double, y double")
    assert df.agg(safe_corr("x", "y")).first()[0] is None
    df2 = spark.createDataFrame([(1.0, 2.0), (2.0, 4.1), (3.0, 5.9), (None, 1.0)],
                                "x double, y double")
    assert df2.agg(safe_corr("x", "y")).first()[0] == pytest.approx(
        df2.dropna().agg(F.corr("x", "y")).first()[0])


def _lag_rows(spark, n, change_1m, counts=None, region="South East", ptype="D"):
    rows = []
    for i in range(n):
        m = D(2000 + i // 12, i % 12 + 1, 1)
        c = counts[i] if counts else 100 + (i * 37) % 50
        r1 = change_1m(i)
        rows.append((m, "KENT", region, ptype, c, r1, r1))
    return spark.createDataFrame(rows, "month date, region string, broad_region string, "
                                       "property_type string, transaction_count bigint, "
                                       "rate_change_1m double, rate_change_3m double")


def test_sensitivity_min_months_and_null_score(spark):
    only_hikes = _lag_rows(spark, 20, lambda i: 0.25)
    out = marts.regional_sensitivity(only_hikes).collect()
    assert len(out) == 1 and out[0].sensitivity_score is None
    assert out[0].rate_volume_correlation is None  # constant rate change
    short = _lag_rows(spark, 14, lambda i: 0.25 if i % 2 else -0.25)  # 14 - 3 lags = 11
    assert marts.regional_sensitivity(short).count() == 0


def test_sensitivity_zero_smoothed_volume_dropped(spark):
    counts = [0, 0, 0] + [10] * 17
    df = _lag_rows(spark, 20, lambda i: 0.25 if i % 2 else -0.25, counts=counts)
    out = marts.regional_sensitivity(df).first()
    # rows 0-2 have no lag; the smoothed means of rows 0-2 are 0, so rows 3-5
    # divide by zero -> NULL pct -> dropped
    assert out.months_observed == 20 - 3 - 3


def test_sensitivity_lag_counts_surviving_rows(spark):
    # rows with a NULL 1-month change are dropped before the 3-row lag
    df = _lag_rows(spark, 24, lambda i: None if i in (5, 6) else (0.25 if i % 2 else -0.25))
    out = marts.regional_sensitivity(df).first()
    assert out.months_observed == 22 - 3


def _monthly(spark, months):
    rows = [(m, "KENT", "South East", "D", 10, 100.0, 100, 90, 110) for m in months]
    return spark.createDataFrame(rows, "month date, region string, broad_region string, "
                                       "property_type string, transaction_count bigint, "
                                       "avg_price double, median_price bigint, "
                                       "min_price bigint, max_price bigint")


def test_rate_lag_analysis_month_quirks(spark):
    rec = _rates(spark, [("2020-01-10", 1.0), ("2020-02-05", 2.0), ("2020-04-11", 0.25),
                         ("2020-04-19", 0.10)])
    months = [D(2019, 12, 1), D(2020, 1, 1), D(2020, 2, 1), D(2020, 4, 1)]
    out = {r.month: r for r in marts.rate_lag_analysis(_monthly(spark, months), rec).collect()}
    # before the first rate: everything NULL
    assert out[D(2019, 12, 1)].rate_at_month is None
    assert out[D(2019, 12, 1)].property_type_label == "Detached"
    # two changes in April: the later one applies
    assert out[D(2020, 4, 1)].rate_at_month == 0.10
    # March has no transactions: April's 1-month lag is NULL (calendar, not row)
    assert out[D(2020, 4, 1)].rate_lag_1m is None
    assert out[D(2020, 4, 1)].rate_lag_2m == 2.0
    assert out[D(2020, 4, 1)].rate_change_2m == pytest.approx(0.10 - 2.0)
    # February: lag 1 month = January's rate
    assert out[D(2020, 2, 1)].rate_lag_1m == 1.0 and out[D(2020, 2, 1)].rate_change_1m == 1.0


def test_monthly_mart_key_and_null_county(spark):
    e = spark.createDataFrame(
        [(D(2020, 1, 1), None, "Other England", "D", 100, 1.0, 2.0),
         (D(2020, 1, 1), "KENT", "South East", "D", 300, 1.0, None),
         (D(2020, 1, 1), "KENT", "South East", "D", 200, 1.0, None)],
        "transaction_month date, region string, broad_region string, property_type string, "
        "price bigint, base_rate double, gilt_yield_pct double")
    out = {r.region: r for r in marts.monthly_transactions_by_region(e).collect()}
    assert out[None].month_region_key is None
    k = out["KENT"]
    assert k.month_region_key == "2020-01-01_KENT_D"
    assert (k.transaction_count, k.min_price, k.max_price, k.median_price) == (2, 200, 300, 200)
    assert k.avg_gilt_yield_pct is None


def test_backfill_truncates_daily_rows(spark, tmp_path):
    from ratetide.sinks import append

    path = str(tmp_path / "rates")
    daily = spark.createDataFrame([(D(2026, 1, 5), 3.5, "daily", None)],
                                  "effective_date date, base_rate double, source string, "
                                  "loaded_at timestamp")
    append(daily, path)
    assert rates.backfill_rates(spark, path, loaded_at="2026-01-06 00:00:00") == 69
    got = spark.read.parquet(path)
    assert got.count() == 69 and got.filter(F.col("source") == "daily").count() == 0
    assert staging.stg_rates(got).count() == 69


def test_asof_ignores_null_series_keys(spark):
    s = spark.createDataFrame([(None, 9.0), (D(2020, 2, 1), 1.0)], "m date, v double")
    p = spark.createDataFrame([(D(2020, 1, 1),), (D(2020, 3, 1),)], "m date")
    got = {r.m: r.v for r in asof_lookup(p, "m", s, "m", "v").collect()}
    assert got == {D(2020, 1, 1): None, D(2020, 3, 1): 1.0}


def test_hot_null_key_collapses_to_one_row(spark):
    # a third of all rows share one (NULL) id: the partial top-1 before the
    # shuffle reduces it per task, and it ends as a single staged row
    rows = [tx(i, f"2020-{i % 12 + 1:02d}-01", price=100 + i) for i in range(2000)]
    hot = [dict(tx(0, f"2021-{i % 12 + 1:02d}-0{i % 9 + 1}", price=i), transaction_id=None)
           for i in range(1000)]
    df = raw_tx(spark, rows + hot).repartition(8)
    out = staging.stg_transactions(df)
    assert out.count() == 2000 + 1
    kept = out.filter(F.col("transaction_id").isNull()).collect()
    assert len(kept) == 1 and kept[0].transaction_date == D(2021, 12, 9)


def test_shuffle_partitions_for():
    from ratetide.session import shuffle_partitions_for

    assert shuffle_partitions_for(0) == 8
    assert shuffle_partitions_for(100 * 2**40) == 100 * 2**40 // (256 * 2**20)  # 100 TiB
    assert shuffle_partitions_for(300 * 2**20) == 8
