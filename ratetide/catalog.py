"""Registered queries: one per model / operator, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's test tables through ``sources.bindings`` (or
data Spark derives from them), so its work grows with them.  Averages that
depend on summation order are rounded to 6 decimals for the oracle compare.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions.columns import (month_start, normalize_key, parse_txn_date,
                                property_type_label, safe_corr, safe_divide)
from .operators.asof import asof_lookup
from .operators.bucket import bucket_dimension
from .operators.calendar import calendar_lag
from .operators.changes import detect_changes
from .operators.dedup import dedup_latest
from .operators.median import exact_median
from .plans import enrich, marts, rates
from .plans.graph import ModelGraph
from .sources import bindings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(key: str):
    def deco(fn):
        QUERIES[key] = fn
        return fn
    return deco


def _g(spark: SparkSession, sf_dir: str) -> ModelGraph:
    return ModelGraph.from_testdata(spark, sf_dir)


def r6(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.round(c, 6))
    return df


# ----------------------------------------------------------------- models
@register("stg_transactions")
def q_stg_transactions(spark, sf_dir):
    return _g(spark, sf_dir).stg_transactions


@register("stg_rates")
def q_stg_rates(spark, sf_dir):
    return _g(spark, sf_dir).stg_rates


@register("stg_yields")
def q_stg_yields(spark, sf_dir):
    return _g(spark, sf_dir).stg_yields


@register("stg_rate_events")
def q_stg_rate_events(spark, sf_dir):
    return _g(spark, sf_dir).stg_rate_events


@register("int_rates_reconciled")
def q_int_rates_reconciled(spark, sf_dir):
    return _g(spark, sf_dir).int_rates_reconciled


@register("rate_for_month")
def q_rate_for_month(spark, sf_dir):
    g = _g(spark, sf_dir)
    return rates.rate_for_month(enrich.transaction_months(g.stg_transactions),
                                "transaction_month", g.int_rates_reconciled)


@register("int_transactions_with_rates")
def q_int_transactions_with_rates(spark, sf_dir):
    return r6(_g(spark, sf_dir).int_transactions_with_rates, "gilt_yield_pct")


@register("rate_change_events")
def q_rate_change_events(spark, sf_dir):
    return _g(spark, sf_dir).rate_change_events


@register("monthly_transactions_by_region")
def q_monthly(spark, sf_dir):
    return r6(_g(spark, sf_dir).monthly_transactions_by_region,
              "avg_price", "avg_base_rate", "avg_gilt_yield_pct")


@register("rate_lag_analysis")
def q_rate_lag_analysis(spark, sf_dir):
    return r6(_g(spark, sf_dir).rate_lag_analysis, "avg_price")


@register("regional_sensitivity")
def q_regional_sensitivity(spark, sf_dir):
    return _g(spark, sf_dir).regional_sensitivity


# ----------------------------------------------------------------- filters / projections
@register("filter_active_after_dedup")
def q_filter_active_after_dedup(spark, sf_dir):
    raw = bindings.raw_table(spark, sf_dir, "transactions")
    latest = dedup_latest(raw, ["transaction_id"], ["transaction_date"])
    return (latest.filter(F.col("record_status") == "A")
                  .select("transaction_id", "transaction_date", "price", "record_status"))


@register("filter_min_date")
def q_filter_min_date(spark, sf_dir):
    raw = bindings.raw_table(spark, sf_dir, "transactions")
    return (raw.filter(F.left("transaction_date", F.lit(10)) >= F.lit("1997-01-01"))
               .select("transaction_id", "transaction_date", "record_status"))


@register("filter_between")
def q_filter_between(spark, sf_dir):
    return (bindings.raw_table(spark, sf_dir, "rates")
            .filter(F.col("base_rate").between(0, 20))
            .select("effective_date", "base_rate", "loaded_at"))


@register("case_label")
def q_case_label(spark, sf_dir):
    raw = bindings.raw_table(spark, sf_dir, "transactions")
    return (raw.groupBy("property_type", property_type_label("property_type")
                        .alias("property_type_label"))
               .agg(F.count(F.lit(1)).alias("n")))


@register("bucket_dimension")
def q_bucket_dimension(spark, sf_dir):
    raw = bindings.raw_table(spark, sf_dir, "transactions")
    b = bucket_dimension(raw, "county", bindings.county_map(spark, sf_dir), "broad_region")
    return b.groupBy("county", "broad_region").agg(F.count(F.lit(1)).alias("n"))


@register("fn_parse_date")
def q_fn_parse_date(spark, sf_dir):
    raw = bindings.raw_table(spark, sf_dir, "transactions")
    return raw.select("transaction_id", "transaction_date",
                      parse_txn_date("transaction_date").alias("parsed_date"),
                      month_start(parse_txn_date("transaction_date")).alias("parsed_month"))


@register("fn_normalize")
def q_fn_normalize(spark, sf_dir):
    raw = bindings.raw_table(spark, sf_dir, "transactions")
    return (raw.select(normalize_key("county").alias("county_key"),
                       normalize_key("postcode").alias("postcode"))
               .groupBy("county_key", "postcode").agg(F.count(F.lit(1)).alias("n")))


@register("fn_safe_divide")
def q_fn_safe_divide(spark, sf_dir):
    lag = _g(spark, sf_dir).rate_lag_analysis
    return (lag.select("month", "rate_at_month", "rate_lag_1m",
                       safe_divide("rate_change_1m", "rate_lag_1m").alias("rel_change_1m"))
               .distinct()
               .transform(lambda d: r6(d, "rel_change_1m")))


# ----------------------------------------------------------------- joins
def _history_months(spark, sf_dir):
    g = _g(spark, sf_dir)
    return enrich.transaction_months(g.stg_transactions), rates.rate_history(spark)


@register("join_asof_interval")
def q_join_asof_interval(spark, sf_dir):
    months, hist = _history_months(spark, sf_dir)
    return rates.rate_for_month(months, "transaction_month", hist, how="left")


@register("join_asof_maxby")
def q_join_asof_maxby(spark, sf_dir):
    months, hist = _history_months(spark, sf_dir)
    return rates.rate_for_month(months, "transaction_month", hist, how="inner")


@register("join_left_month")
def q_join_left_month(spark, sf_dir):
    g = _g(spark, sf_dir)
    rfm = rates.rate_for_month(g.transaction_months, "transaction_month", g.int_rates_reconciled)
    t = g.stg_transactions.select("transaction_id",
                                  month_start("transaction_date").alias("transaction_month"))
    return t.join(writers.materialize(rfm, "rfm"), "transaction_month", "left")


@register("join_calendar_lag")
def q_join_calendar_lag(spark, sf_dir):
    g = _g(spark, sf_dir)
    months = g.monthly_table.select("month").distinct()
    ctx = marts.rate_context(months, "month", g.int_rates_reconciled)
    return (months.join(ctx, "month", "left")
                  .withColumnRenamed("base_rate", "rate_at_month"))


# ----------------------------------------------------------------- aggregations
@register("agg_monthly")
def q_agg_monthly(spark, sf_dir):
    e = _g(spark, sf_dir).int_transactions_with_rates
    return r6(e.groupBy(F.col("transaction_month").alias("month"), "region", "broad_region",
                        "property_type")
               .agg(F.count(F.lit(1)).alias("transaction_count"),
                    F.avg("price").alias("avg_price"),
                    F.min("price").alias("min_price"),
                    F.max("price").alias("max_price")), "avg_price")


@register("agg_approx_median")
def q_agg_approx_median(spark, sf_dir):
    t = _g(spark, sf_dir).stg_transactions
    return (t.groupBy(month_start("transaction_date").alias("month"), "property_type")
             .agg(F.percentile_approx("price", 0.5, 10000).alias("median_price")))


@register("agg_exact_median")
def q_agg_exact_median(spark, sf_dir):
    t = _g(spark, sf_dir).stg_transactions
    return exact_median(t, ["broad_region", "property_type"], "price", out="median_price")


@register("agg_monthly_yield")
def q_agg_monthly_yield(spark, sf_dir):
    return r6(enrich.monthly_yields(_g(spark, sf_dir).stg_yields), "avg_yield_pct")


@register("agg_distinct_months")
def q_agg_distinct_months(spark, sf_dir):
    return enrich.transaction_months(_g(spark, sf_dir).stg_transactions)


def _rs_frames(spark, sf_dir):
    """The intermediate frames of the sensitivity model, for operator keys."""
    return marts.sensitivity_steps(_g(spark, sf_dir).rate_lag_analysis)


@register("agg_rollup_broad")
def q_agg_rollup_broad(spark, sf_dir):
    return _rs_frames(spark, sf_dir)[0]


@register("win_moving_avg")
def q_win_moving_avg(spark, sf_dir):
    return r6(_rs_frames(spark, sf_dir)[1], "rolling_3m_avg_txns")


@register("win_lag3")
def q_win_lag3(spark, sf_dir):
    pct = _rs_frames(spark, sf_dir)[2]
    return r6(pct.select("month", "broad_region", "property_type", "rolling_3m_avg_txns",
                         "pct_vol_change_3m"), "rolling_3m_avg_txns", "pct_vol_change_3m")


def _rs_valid(spark, sf_dir):
    return _rs_frames(spark, sf_dir)[2].filter(F.col("pct_vol_change_3m").isNotNull())


@register("agg_corr")
def q_agg_corr(spark, sf_dir):
    p = _rs_valid(spark, sf_dir)
    return (p.groupBy("broad_region", "property_type")
             .agg(F.round(safe_corr("rate_change_3m", "pct_vol_change_3m"), 6)
                  .alias("rate_volume_correlation")))


@register("agg_conditional_avg")
def q_agg_conditional_avg(spark, sf_dir):
    p = _rs_valid(spark, sf_dir)
    pct = F.col("pct_vol_change_3m")
    return (p.groupBy("broad_region", "property_type")
             .agg(F.round(F.avg(F.when(F.col("rate_change_1m") > 0, pct)), 6)
                  .alias("avg_vol_change_after_hike"),
                  F.round(F.avg(F.when(F.col("rate_change_1m") < 0, pct)), 6)
                  .alias("avg_vol_change_after_cut")))


@register("agg_having")
def q_agg_having(spark, sf_dir):
    p = _rs_valid(spark, sf_dir)
    return (p.groupBy("broad_region", "property_type")
             .agg(F.count(F.lit(1)).alias("months_observed"))
             .filter(F.col("months_observed") >= 12))


# ----------------------------------------------------------------- windows / sets
@register("win_dedup_latest")
def q_win_dedup_latest(spark, sf_dir):
    raw = bindings.raw_table(spark, sf_dir, "transactions")
    return dedup_latest(raw, ["transaction_id"], ["transaction_date"])


@register("win_dedup_priority")
def q_win_dedup_priority(spark, sf_dir):
    return _g(spark, sf_dir).int_rates_reconciled.select("effective_date", "source_type",
                                                          "base_rate")


@register("win_lag")
def q_win_lag(spark, sf_dir):
    rec = _g(spark, sf_dir).int_rates_reconciled
    w = Window.orderBy("effective_date")
    return rec.select("effective_date", "base_rate",
                      F.lag("base_rate").over(w).alias("previous_rate"))


@register("set_union_all_tagged")
def q_set_union_all_tagged(spark, sf_dir):
    g = _g(spark, sf_dir)
    batch = g.stg_rates.select("effective_date", "base_rate",
                               F.lit("batch").alias("source_type"))
    stream = g.stg_rate_events.select("effective_date", F.col("new_rate").alias("base_rate"),
                                      F.lit("streaming").alias("source_type"))
    return batch.unionByName(stream)


@register("detect_changes")
def q_detect_changes(spark, sf_dir):
    s = _g(spark, sf_dir).stg_rates.select("effective_date", "base_rate")
    return detect_changes(s, "effective_date", "base_rate", emit_first=True)


@register("asof_partitioned")
def q_asof_partitioned(spark, sf_dir):
    """As-of per series: each (ticker, month) of the yield series gets the
    latest daily yield at or before the month start, per ticker."""
    y = bindings.raw_table(spark, sf_dir, "yields").filter(F.col("date").isNotNull())
    daily = (y.groupBy("ticker", "date").agg(F.max("yield_pct").alias("yield_pct")))
    months = daily.select("ticker", month_start("date").alias("month"))
    return asof_lookup(months, "month", daily, "date", "yield_pct", how="left",
                       partition_by=["ticker"])


@register("calendar_lag_yields")
def q_calendar_lag_yields(spark, sf_dir):
    """Calendar lags of the monthly yield average (months with no yields -> NULL)."""
    m = enrich.monthly_yields(_g(spark, sf_dir).stg_yields).withColumnRenamed(
        "yield_month", "month")
    lagged = calendar_lag(m, "month", "avg_yield_pct", (1, 3, 12),
                          name=lambda n: f"yield_lag_{n}m")
    return r6(m.select("month").join(lagged, "month", "left"),
              "avg_yield_pct", "yield_lag_1m", "yield_lag_3m", "yield_lag_12m")


# ----------------------------------------------------------------- sinks
from .plans.incremental import run_monthly_incremental  # noqa: E402
from .plans.marts import MONTHLY_COLUMNS  # noqa: E402
from .quality import checks as Q  # noqa: E402
from .quality import suites as S  # noqa: E402
from .session import scratch_path  # noqa: E402
from .sinks import writers  # noqa: E402

_MONTHLY_AVGS = ("avg_price", "avg_base_rate", "avg_gilt_yield_pct")


def _monthly_where(g: ModelGraph, cond) -> DataFrame:
    return marts.monthly_transactions_by_region(g.int_transactions_with_rates.filter(cond))


@register("sink_append_then_dedup")
def q_sink_append_then_dedup(spark, sf_dir):
    """Two appends of the same daily load (a rerun) then staging dedup."""
    from .plans.staging import stg_rates

    path = scratch_path(spark, "rates_append")
    raw = bindings.raw_table(spark, sf_dir, "rates")
    writers.append(raw, path)
    writers.append(raw, path)
    return stg_rates(spark.read.parquet(path))


@register("sink_overwrite")
def q_sink_overwrite(spark, sf_dir):
    """Append, then a truncate-load replaces the whole table."""
    path = scratch_path(spark, "rates_overwrite")
    raw = bindings.raw_table(spark, sf_dir, "rates")
    writers.append(raw, path)
    writers.overwrite(raw.filter(F.col("base_rate") <= 20), path)
    return spark.read.parquet(path)


@register("sink_merge_upsert")
def q_sink_merge_upsert(spark, sf_dir):
    """Old mart (sales before 2000) upserted with a delta mart (sales from
    1999-10-15): overlapping keys replaced, others kept, new inserted."""
    g = _g(spark, sf_dir)
    path = scratch_path(spark, "monthly_upsert")
    old = _monthly_where(g, F.col("transaction_date") < F.lit("2000-01-01").cast("date"))
    delta = _monthly_where(g, F.col("transaction_date") >= F.lit("1999-10-15").cast("date"))
    keys = ["month", "region", "property_type"]
    writers.merge_upsert(spark, path, old.select(*MONTHLY_COLUMNS), keys)
    writers.merge_upsert(spark, path, delta.select(*MONTHLY_COLUMNS), keys)
    return r6(spark.read.parquet(path).select(*MONTHLY_COLUMNS), *_MONTHLY_AVGS)


@register("sink_schema_sync")
def q_sink_schema_sync(spark, sf_dir):
    """Incremental write whose delta drops one column and adds another."""
    g = _g(spark, sf_dir)
    path = scratch_path(spark, "monthly_schema")
    old = _monthly_where(g, F.col("transaction_month") < F.lit("2000-01-01").cast("date"))
    delta = (_monthly_where(g, F.col("transaction_month") >= F.lit("2000-01-01").cast("date"))
             .drop("avg_gilt_yield_pct")
             .withColumn("price_range", F.col("max_price") - F.col("min_price")))
    keys = ["month", "region", "property_type"]
    writers.merge_upsert(spark, path, old.select(*MONTHLY_COLUMNS), keys)
    writers.merge_upsert(spark, path, delta, keys)
    return r6(spark.read.parquet(path), "avg_price", "avg_base_rate")


@register("sink_upsert_null_partition")
def q_sink_upsert_null_partition(spark, sf_dir):
    """Upsert into a table with rows that have no partition value (flats carry
    no month here): rows of that partition whose key is not in the delta stay."""
    t = _g(spark, sf_dir).stg_transactions
    rows = (t.groupBy(F.when(F.col("property_type") != "F", month_start("transaction_date")).alias("month"),
                      "town_city", "property_type").agg(F.count(F.lit(1)).alias("n")))
    path = scratch_path(spark, "null_partition")
    keys = ["month", "town_city", "property_type"]
    writers.merge_upsert(spark, path, rows, keys)
    delta = rows.filter(F.col("town_city") < "G").withColumn("n", F.col("n") * 10)
    writers.merge_upsert(spark, path, delta, keys)
    return spark.read.parquet(path).select(*rows.columns)


@register("sink_partitioned")
def q_sink_partitioned(spark, sf_dir):
    """Mart written partitioned by month, clustered by region/type; read back."""
    path = scratch_path(spark, "monthly_partitioned")
    writers.write_partitioned(_g(spark, sf_dir).monthly_transactions_by_region, path, "month",
                              ["region", "property_type"])
    return r6(spark.read.parquet(path).select(*MONTHLY_COLUMNS), *_MONTHLY_AVGS)


@register("monthly_incremental")
def q_monthly_incremental(spark, sf_dir):
    """History load (raw rows dated before 2000) then one incremental run
    over all rows with a one-month overlap.  The result is the history with
    every reprocessed month upserted; groups that vanished on reprocessing
    (a reload moved the sale into a later month) are kept, as a MERGE
    keeps them."""
    path = scratch_path(spark, "monthly_incremental")
    raw = bindings.raw_table(spark, sf_dir, "transactions")
    hist = ModelGraph.from_testdata(spark, sf_dir)
    hist.raw["transactions"] = raw.filter(F.left("transaction_date", F.lit(10)) < "2000-01-01")
    run_monthly_incremental(spark, lambda since: hist.int_transactions_with_rates, path)

    def enriched(since):
        p = {"stg_transactions": {"since": str(since)}} if since else {}
        return ModelGraph.from_testdata(spark, sf_dir, params=p).int_transactions_with_rates

    run_monthly_incremental(spark, enriched, path, overlap_months=1)
    return r6(spark.read.parquet(path).select(*MONTHLY_COLUMNS), *_MONTHLY_AVGS)


@register("incremental_after_empty")
def q_incremental_after_empty(spark, sf_dir):
    """A first load without rows, then an incremental run: a full load."""
    path = scratch_path(spark, "monthly_empty")
    g = _g(spark, sf_dir)
    run_monthly_incremental(spark, lambda since: g.int_transactions_with_rates.filter("false"), path)
    run_monthly_incremental(spark, lambda since: g.int_transactions_with_rates, path)
    return r6(spark.read.parquet(path).select(*MONTHLY_COLUMNS), *_MONTHLY_AVGS)


@register("incremental_cutoff")
def q_incremental_cutoff(spark, sf_dir):
    """The delta an incremental run computes against a history target."""
    from .plans.incremental import incremental_cutoff

    path = scratch_path(spark, "monthly_cutoff")
    g = _g(spark, sf_dir)
    hist = _monthly_where(g, F.col("transaction_date") < F.lit("2000-01-01").cast("date"))
    writers.write_partitioned(hist.select(*MONTHLY_COLUMNS), path, "month")
    cutoff = incremental_cutoff(spark, path, overlap_months=1)
    return r6(_monthly_where(g, F.col("transaction_month") >= F.lit(cutoff)), *_MONTHLY_AVGS)


# ----------------------------------------------------------------- data quality
def _dq_tables(spark, sf_dir):
    """Table name -> zero-argument builder (only the checked tables are built)."""
    g = _g(spark, sf_dir)
    raw = {f"raw_{k}": (lambda k=k: g.raw[k]) for k in g.raw}
    models = ["stg_transactions", "stg_rates", "stg_yields", "stg_rate_events",
              "int_rates_reconciled", "int_transactions_with_rates",
              "monthly_transactions_by_region", "rate_change_events", "rate_lag_analysis",
              "regional_sensitivity"]
    return {**raw, **{m: (lambda m=m: getattr(g, m)) for m in models}}


def _dq(key: str, spec: list[tuple[str, list]]):
    """Register a check query: ``spec`` = [(table, checks), ...]."""

    def run(spark, sf_dir):
        tabs = _dq_tables(spark, sf_dir)
        parts = [Q.run_checks(tabs[t](), chks).select(F.lit(t).alias("table"), "*")
                 for t, chks in spec]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
    run.__name__ = f"q_{key}"
    register(key)(run)


_dq("dq_suite_transactions", [("raw_transactions", S.RAW_TRANSACTIONS)])
_dq("dq_suite_rates", [("raw_rates", S.RAW_RATES)])
_dq("dq_unique", [("raw_transactions", [Q.Unique("transaction_id"), Q.Unique("paon")]),
                  ("stg_transactions", [Q.Unique("transaction_id")])])
_dq("dq_between_mostly", [("raw_transactions", [
    Q.Between("price", 1, 100_000_000, mostly=0.999),
    Q.Between("price", 2000, 400_000, mostly=0.999),
    Q.Between("price", 2000, 400_000, mostly=0.9)])])
_dq("dq_accepted_values", [("raw_transactions", [
    Q.InSet("property_type", S.PROPERTY_TYPES), Q.InSet("record_status", ("A", "C", "D")),
    Q.InSet("record_status", ("A",), mostly=0.5), Q.InSet("ppd_category", ("A",))]),
    ("rate_change_events", [Q.InSet("direction", ("hike", "cut"))])])
_dq("dq_row_count", [("raw_transactions", [Q.RowCountBetween(None, 1000, 2_000_000)]),
                     ("raw_rates", [Q.RowCountBetween(None, 1, 10)])])
_dq("dq_accepted_range", [
    ("stg_yields", [Q.AcceptedRange("yield_pct", 0, 25)]),
    ("stg_rates", [Q.AcceptedRange("base_rate", 0, 20)]),
    ("monthly_transactions_by_region", [Q.AcceptedRange("transaction_count", 0, None, False),
                                        Q.AcceptedRange("avg_price", 0, None, False)])])
_dq("dq_positive_prices", [("stg_transactions", [S.POSITIVE_PRICES])])
_dq("dq_lag_completeness", [("rate_lag_analysis", [S.LAG_COMPLETENESS])])
_dq("dq_model_suites", [(t, c) for t, c in S.SUITES.items() if t not in ("raw_rates",)
                        and all(not isinstance(x, Q.NoRowsWhere) or "current_date" not in
                                x.predicate for x in c)])


@register("dq_no_future_dates")
def q_dq_no_future_dates(spark, sf_dir):
    """Offending rows of the no-future-dates assertion with 'today' = 2001-06-30."""
    t = _g(spark, sf_dir).stg_transactions
    return (t.filter(F.expr(S.no_future_dates("2001-06-30").predicate))
             .select("transaction_id", "transaction_date"))


@register("dq_quarantine")
def q_dq_quarantine(spark, sf_dir):
    """Raw transactions split into good and bad rows, bad ones with all checks they
    fail.  Tolerated shares and warnings send no row away."""
    from .quality.quarantine import FAILED, split_rows

    good, bad = split_rows(bindings.raw_table(spark, sf_dir, "transactions"), [
        Q.NotNull("county"), Q.AcceptedRange("price", 20_000, 200_000), Q.InSet("record_status", ("A", "D")),
        Q.Unique("transaction_id"), Q.NoRowsWhere("transaction_date", "transaction_date > '1998-06-30'", "not_later"),
        Q.Between("price", 50_000, 100_000, mostly=0.9), Q.Unique("paon", severity="warn")])
    cols = ["transaction_id", "transaction_date", "price", "record_status", "county"]
    return (bad.select(*cols, F.lit("bad").alias("verdict"), F.array_join(FAILED, ",").alias(FAILED))
            .unionByName(good.select(*cols, F.lit("good").alias("verdict"), F.lit("").alias(FAILED))))


# ----------------------------------------------------------------- streaming
from .streaming import changes as SC  # noqa: E402
from .streaming import events as SE  # noqa: E402

DEFAULT_TS = "2024-02-01 00:00:00"


def event_messages_from_events(spark, sf_dir) -> DataFrame:
    """Rate-change messages derived from the events table, one per event:
    'purchase' complete; 'view' with a numeric-string rate; 'click' without
    published_at; 'signup' without new_rate; 'error' not JSON at all."""
    e = bindings.table(spark, sf_dir, "events")
    eid = F.concat(F.lit("e"), F.expr("event_id div 20").cast("string")).alias("event_id")
    eff = bindings.event_day(1).alias("effective_date")
    prev = (F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("double"))
             .otherwise(F.col("value") / 25).alias("previous_rate"))
    new = (F.col("value") / 20).alias("new_rate")
    pub = F.col("ts").cast("timestamp").alias("published_at")
    opts = {"timestampFormat": SE.MESSAGE_TS_FORMAT}
    t = F.col("event_type")
    msg = (F.when(t == "error", F.concat(F.lit("not json "), F.col("event_id").cast("string")))
            .when(t == "view", F.to_json(F.struct(
                eid, eff, prev, (F.col("value") / 20).cast("string").alias("new_rate"), pub),
                opts))
            .when(t == "click", F.to_json(F.struct(eid, eff, prev, new), opts))
            .when(t == "signup", F.to_json(F.struct(eid, eff, prev, pub), opts))
            .otherwise(F.to_json(F.struct(eid, eff, prev, new, pub), opts)))
    return e.select(msg.alias("value"))


@register("stream_parse")
def q_stream_parse(spark, sf_dir):
    return SE.valid_events(SE.parse_messages(event_messages_from_events(spark, sf_dir),
                                             default_ts=DEFAULT_TS))


@register("stream_quarantine")
def q_stream_quarantine(spark, sf_dir):
    bad = SE.bad_events(SE.parse_messages(event_messages_from_events(spark, sf_dir),
                                          default_ts=DEFAULT_TS))
    return bad.groupBy("error").agg(F.count(F.lit(1)).alias("n"))


def _run_ingest(spark, sf_dir) -> str:
    root = scratch_path(spark, "stream")
    event_messages_from_events(spark, sf_dir).write.text(f"{root}/in")
    q = SE.start_ingest(spark, f"{root}/in", f"{root}/events", f"{root}/quarantine",
                        f"{root}/_checkpoints", available_now=True, default_ts=DEFAULT_TS)
    q.awaitTermination()
    return root


@register("stream_ingest")
def q_stream_ingest(spark, sf_dir):
    """Messages landed as files, ingested by the streaming job (availableNow)
    into the append-only event table; the table is read back."""
    root = _run_ingest(spark, sf_dir)
    return spark.read.parquet(f"{root}/events").select(*SE.EVENT_COLUMNS)


@register("stream_dedup")
def q_stream_dedup(spark, sf_dir):
    """Streamed events table -> staging dedup (latest published_at wins)."""
    from .plans.staging import stg_rate_events

    root = _run_ingest(spark, sf_dir)
    return stg_rate_events(spark.read.parquet(f"{root}/events"))


@register("stream_detect_changes")
def q_stream_detect_changes(spark, sf_dir):
    """Daily batch rates replayed as a stream through the stateful change
    detector (state = last rate per series)."""
    return _detected(spark, sf_dir).select("event_id", "effective_date", "previous_rate", "new_rate")


def _rate_series(spark, sf_dir) -> DataFrame:
    """Batch rates as observed series, one for each year."""
    return _g(spark, sf_dir).stg_rates.select(
        F.concat(F.lit("policy-"), F.year("effective_date")).alias("series"), "effective_date", "base_rate")


def _detected(spark, sf_dir) -> DataFrame:
    root = scratch_path(spark, "changes")
    # a series arrives in one file, so in order; a trigger takes two files
    _rate_series(spark, sf_dir).repartition("series").write.json(f"{root}/in")
    stream = (spark.readStream.schema("series string, effective_date date, base_rate double")
              .option("maxFilesPerTrigger", 2).json(f"{root}/in"))
    q = (SC.detect_changes_stream(stream, published_at=DEFAULT_TS).writeStream.format("parquet")
         .outputMode("append").option("path", f"{root}/out").option("checkpointLocation", f"{root}/_ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out")


@register("stream_reconcile")
def q_stream_reconcile(spark, sf_dir):
    """Detected changes published as messages, ingested into the event table,
    staged, and reconciled with the batch rates (the stream wins a date)."""
    from .plans.staging import stg_rate_events

    root = scratch_path(spark, "reconcile")
    SE.event_messages(_detected(spark, sf_dir)).write.text(f"{root}/in")
    SE.start_ingest(spark, f"{root}/in", f"{root}/events", f"{root}/quarantine",
                    f"{root}/_checkpoints").awaitTermination()
    events = stg_rate_events(spark.read.parquet(f"{root}/events"))
    return rates.int_rates_reconciled(_g(spark, sf_dir).stg_rates, events).select(
        "effective_date", "base_rate", "source_type", "effective_month")


@register("stream_ingest_twice")
def q_stream_ingest_twice(spark, sf_dir):
    """Two ingests with checkpoints of their own into one event table: the
    second adds to the first."""
    root = scratch_path(spark, "twice")
    messages = event_messages_from_events(spark, sf_dir)
    even = F.crc32("value") % 2 == 0
    for name, part in (("a", messages.filter(even)), ("b", messages.filter(~even))):
        part.write.text(f"{root}/in-{name}")
        SE.start_ingest(spark, f"{root}/in-{name}", f"{root}/events", f"{root}/quarantine",
                        f"{root}/_checkpoints-{name}", default_ts=DEFAULT_TS).awaitTermination()
    return spark.read.parquet(f"{root}/events").select(*SE.EVENT_COLUMNS)


@register("stream_compact")
def q_stream_compact(spark, sf_dir):
    """The event table of two ingests with several micro-batches each, compacted
    after each of them (the first time without the newest batch), then staged."""
    from .plans.staging import stg_rate_events
    from .streaming.compact import compact_events, read_events

    root = scratch_path(spark, "compact")
    sink, table = f"{root}/events", f"{root}/compacted"
    messages = event_messages_from_events(spark, sf_dir)
    even = F.crc32("value") % 2 == 0
    for name, part in (("a", messages.filter(even)), ("b", messages.filter(~even))):
        part.repartition(4, "value").write.text(f"{root}/in-{name}")
        source = SE.read_message_stream(spark, f"{root}/in-{name}", max_files_per_trigger=2)
        SE.start_ingest(spark, None, sink, f"{root}/quarantine", f"{root}/_checkpoints-{name}",
                        default_ts=DEFAULT_TS, source=source).awaitTermination()
        compact_events(spark, sink, table, keep_newest=name == "a")
    return stg_rate_events(read_events(spark, sink, table))


@register("stream_detect_late")
def q_stream_detect_late(spark, sf_dir):
    """Daily batch rates in files that mix all dates, detected as they come; the
    event table, retractions included, is replayed to the changes that stand."""
    from .streaming.late_changes import replayed_events, start_late_detection

    root = scratch_path(spark, "late")
    series = _rate_series(spark, sf_dir).withColumn("part", F.pmod(F.crc32(F.col("effective_date").cast("string")), F.lit(3)))
    series.repartition(3, "part").drop("part").write.json(f"{root}/in")
    stream = (spark.readStream.schema("series string, effective_date date, base_rate double")
              .option("maxFilesPerTrigger", 1).json(f"{root}/in"))
    start_late_detection(stream, f"{root}/state", f"{root}/_checkpoints", published_at=DEFAULT_TS).awaitTermination()
    return replayed_events(spark, f"{root}/state").select("event_id", "effective_date", "previous_rate", "new_rate")


@register("detect_changes_ids")
def q_detect_changes_ids(spark, sf_dir):
    """Batch twin of the stream detector, with the same deterministic ids."""
    return rates.latest_change_events(_rate_series(spark, sf_dir), series_col="series").drop("series")


# ----------------------------------------------------------------- sources
from .sources import files as SF  # noqa: E402

LANDED_RUN = "2024-01-31"


def _land_transactions(spark, sf_dir) -> str:
    root = scratch_path(spark, "landed_transactions")
    raw = bindings.raw_table(spark, sf_dir, "transactions").withColumns({
        "year": F.left("transaction_date", F.lit(4)), "run_date": F.lit(LANDED_RUN)})
    SF.write_transactions_csv(raw, root, partition_by=["year", "run_date"])
    return root


@register("src_transactions_csv")
def q_src_transactions_csv(spark, sf_dir):
    """Raw transactions landed as headerless CSV under year=/run_date=, read back."""
    root = _land_transactions(spark, sf_dir)
    return SF.read_transactions_csv(spark, root).select(*SF.TRANSACTION_COLUMNS)


@register("src_transactions_csv_split")
def q_src_transactions_csv_split(spark, sf_dir):
    """Landed CSV of both kinds: the files of every fourth year hold street names
    with a line break and a quote and are read whole, the others in splits."""
    from .sources.csv_split import read_transactions_csv_split

    root = scratch_path(spark, "landed_lines")
    year = F.left("transaction_date", F.lit(4))
    broken = F.concat(F.lit('The "Old" House'), F.lit("\n"), F.col("street"))
    raw = bindings.raw_table(spark, sf_dir, "transactions").withColumn(
        "street", F.when(year.cast("int") % 4 == 0, broken).otherwise(F.col("street")))
    SF.write_transactions_csv(raw.withColumn("year", year), root, partition_by=["year"])
    return read_transactions_csv_split(spark, root).select(*SF.TRANSACTION_COLUMNS)


@register("src_year_range")
def q_src_year_range(spark, sf_dir):
    """Backfill read over the landed yearly folders, first to last year."""
    root = _land_transactions(spark, sf_dir)
    span = (bindings.raw_table(spark, sf_dir, "transactions")
            .agg(F.min(F.left("transaction_date", F.lit(4))).alias("lo"),
                 F.max(F.left("transaction_date", F.lit(4))).alias("hi")).first())
    return (SF.read_year_range(spark, root, int(span["lo"]), int(span["hi"]))
            .select(*SF.TRANSACTION_COLUMNS, "year"))


@register("src_rates_json")
def q_src_rates_json(spark, sf_dir):
    root = scratch_path(spark, "landed_rates")
    writers.write_ndjson(bindings.raw_table(spark, sf_dir, "rates"), f"{root}/run_date={LANDED_RUN}")
    return SF.read_rates_json(spark, root).select("effective_date", "base_rate", "source",
                                                  "loaded_at")


@register("src_yields_json")
def q_src_yields_json(spark, sf_dir):
    """Yields landed under date=<run>/ with a data column `date` (name clash)."""
    root = scratch_path(spark, "landed_yields")
    writers.write_ndjson(bindings.raw_table(spark, sf_dir, "yields"), f"{root}/date={LANDED_RUN}")
    return SF.read_yields_json(spark, root)


def _daily_series_lines(spark, sf_dir) -> DataFrame:
    """A public-series style file derived from events: a header, one line per
    day (the day's largest value; '.' when that event is an error), blank lines
    and, as its newest lines, a NaN and one with three fields."""
    e = bindings.table(spark, sf_dir, "events")
    day = F.to_date("ts").cast("string")
    best = (e.groupBy(day.alias("d"))
             .agg(F.max_by(F.struct("event_type", "value"),
                           F.struct("value", "event_id")).alias("b")))
    text = F.concat_ws(",", F.col("d"), F.when(F.col("b.event_type") == "error", F.lit("."))
                       .otherwise(F.col("b.value").cast("string")))
    lines = best.select(text.alias("value"))
    extra = lines.sparkSession.createDataFrame(
        [("observation_date,SERIES",), ("",), ("9998-01-02,NaN",), ("9998-01-03,4.3,x",)], "value string")
    return lines.unionByName(extra)


def _landed_series(spark, sf_dir) -> DataFrame:
    root = scratch_path(spark, "series")
    _daily_series_lines(spark, sf_dir).write.text(root)
    return SF.read_series_lines(spark, root)


@register("src_rate_series_latest")
def q_src_rate_series_latest(spark, sf_dir):
    return SF.latest_positive(_landed_series(spark, sf_dir))


@register("src_yield_series_tail")
def q_src_yield_series_tail(spark, sf_dir):
    return SF.series_tail(_landed_series(spark, sf_dir), 5, "SERIES", loaded_at=DEFAULT_TS)


@register("src_fallback_first_nonempty")
def q_src_fallback_first_nonempty(spark, sf_dir):
    """Primary source empty (no 'Z' return flags) -> fallback market table."""
    li = bindings.table(spark, sf_dir, "lineitem")
    primary = li.filter(F.col("l_returnflag") == "Z")
    fallback = li.select("l_shipdate", (F.col("l_extendedprice") / 100).alias("close"))
    chosen = SF.first_nonempty([
        SF.normalise_market_data(primary.select("l_shipdate", F.col("l_tax").alias("close")),
                                 "l_shipdate", "close", "PRIMARY", DEFAULT_TS),
        SF.normalise_market_data(fallback, "l_shipdate", "close", "FALLBACK", DEFAULT_TS)])
    return chosen


# ----------------------------------------------------------------- DAG runs
@register("dag_full_run")
def q_dag_full_run(spark, sf_dir):
    """The whole DAG written table by table (checks recorded: the bound data
    has NULL counties, which the mart's not-null tests flag), then the
    flagship table read back."""
    from .plans.runner import run_pipeline

    g = _g(spark, sf_dir)
    res = run_pipeline(spark, g.raw, scratch_path(spark, "dag_run"),
                       county_map=g.county_map, check=True, on_failure="warn")
    return spark.read.parquet(res.paths["regional_sensitivity"])


@register("dag_scheduled_run")
def q_dag_scheduled_run(spark, sf_dir):
    """A scheduled rate load: rates, reconciled rates and the change events
    only; the change-event table is read back."""
    from .plans.runner import SCHEDULES, run_pipeline

    g = _g(spark, sf_dir)
    raw = {k: g.raw[k] for k in ("rates", "rate_events")}  # all that a rate load needs
    res = run_pipeline(spark, raw, scratch_path(spark, "scheduled"), targets=SCHEDULES["rates"],
                       on_failure="warn", reuse_tables=True)
    assert set(res.paths) == {"rate_change_events"}
    return spark.read.parquet(res.paths["rate_change_events"])


def _landed_batches(spark, tx: DataFrame, name: str, batches: list[DataFrame]):
    """Land the batches one by one as run_date folders; yields all landed rows after each."""
    from pyspark.sql.types import StringType, StructField, StructType

    root, schema = scratch_path(spark, name), StructType([*tx.schema.fields, StructField("run_date", StringType())])
    for i, batch in enumerate(batches):
        batch.write.parquet(f"{root}/run_date=2024-{i + 1:02d}-28")
        yield spark.read.schema(schema).parquet(root)


def _three_batches(tx: DataFrame) -> list[DataFrame]:
    """Batches that add up to ``tx``: the first lacks a seventh of the ids and dates
    from 2000 on, and its later deletions are still active; the second lands all
    rows, old-dated ones too, a fifth of the ids as deletions of the same date;
    the third withdraws those."""
    number = F.col("transaction_id").cast("bigint")
    status = F.col("record_status")
    early = (F.left("transaction_date", F.lit(10)) < "2000-01-01") & (number % 7 != 0)
    return [tx.filter(early).withColumn("record_status", F.when(status == "D", "A").otherwise(status)),
            tx.withColumn("record_status", F.when(number % 5 == 0, "D").otherwise(status)),
            tx.filter(number % 5 == 0)]


@register("dag_incremental_run")
def q_dag_incremental_run(spark, sf_dir):
    """Staging after three landed batches, each run reading its own run_date
    folders only: the staged table equals a full restage."""
    from .plans.runner import run_pipeline

    g = _g(spark, sf_dir)
    out = scratch_path(spark, "dag_incremental")
    tx = g.raw["transactions"]
    for landed in _landed_batches(spark, tx, "landed_versions", _three_batches(tx)):
        run_pipeline(spark, g.raw | {"transactions": landed}, out, targets=["stg_transactions"],
                     county_map=g.county_map, on_failure="warn")
    return spark.read.parquet(f"{out}/stg_transactions").drop("transaction_month")


@register("marts_change_driven")
def q_marts_change_driven(spark, sf_dir):
    """The lag mart after three batches of transactions, refreshed for changed
    months only; the streamed rates of odd months are revised with the last."""
    from .plans.runner import run_pipeline

    g = _g(spark, sf_dir)
    out = scratch_path(spark, "dag_changed")
    tx, events = g.raw["transactions"], g.raw["rate_events"]
    old = events.withColumn("new_rate", F.when(F.month("effective_date") % 2 == 1, F.col("new_rate") + 1).otherwise(F.col("new_rate")))
    for i, landed in enumerate(_landed_batches(spark, tx, "landed_changes", _three_batches(tx))):
        run_pipeline(spark, g.raw | {"transactions": landed, "rate_events": events if i == 2 else old}, out,
                     targets=["rate_lag_analysis"], county_map=g.county_map, on_failure="warn", change_driven=True)
    return r6(spark.read.parquet(f"{out}/rate_lag_analysis"), "avg_price")


@register("dq_gate")
def q_dq_gate(spark, sf_dir):
    """The gate's view of two landed batches: checks of the newest one."""
    root = scratch_path(spark, "landed_batches")
    tx = bindings.raw_table(spark, sf_dir, "transactions").withColumn(
        "run_date", F.when(F.col("old_new") == "Y", "2024-01-31").otherwise("2024-02-29"))
    SF.write_transactions_csv(tx, root, partition_by=["run_date"])
    newest = Q.newest_partition(SF.read_transactions_csv(spark, root), "run_date")
    return Q.run_checks(newest, [c for c in S.RAW_TRANSACTIONS if not isinstance(c, Q.RowCountBetween)])


@register("win_lead_intervals")
def q_win_lead_intervals(spark, sf_dir):
    """Step-function intervals of the reconciled rate series:
    [effective_month, next change month), the last one open-ended."""
    from .operators.asof import step_intervals

    rec = _g(spark, sf_dir).int_rates_reconciled
    return step_intervals(rec, "effective_month", order=["effective_date"],
                          end_col="next_change_month").select(
        "effective_date", "effective_month", "base_rate", "next_change_month")


# ------------------------------------------------- one long series, by ranges
def _events(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet")


@register("win_lag_ranged")
def q_win_lag_ranged(spark, sf_dir):
    """Events whose type differs from that of the event before, over all events in
    order of time: the change filter on a series of any length."""
    from .operators.ranges import OrderedRanges

    events = _events(spark, sf_dir).select("ts", "event_id", "event_type")
    found = OrderedRanges(events, ["ts", "event_id"]).lag("event_type", "previous_type")
    return found.filter(F.col("previous_type").isNull() | (F.col("previous_type") != F.col("event_type")))


@register("win_lead_ranged")
def q_win_lead_ranged(spark, sf_dir):
    """Validity of each event up to the next one, the last open-ended."""
    from .operators.asof import step_intervals

    return step_intervals(_events(spark, sf_dir).select("ts", "event_id"), "ts", ["event_id"], "next_ts", ranges=0)


@register("asof_ranged")
def q_asof_ranged(spark, sf_dir):
    """The value of the latest view at or before each moment of a purchase."""
    events = _events(spark, sf_dir)
    return asof_lookup(events.filter("event_type = 'purchase'"), "ts", events.filter("event_type = 'view'"), "ts", "value",
                       order=["event_id"], ranges=0)


# ------------------------------------------------------------ mergeable medians
@register("agg_sketch_median")
def q_agg_sketch_median(spark, sf_dir):
    """Median prices per broad region and property type out of stored monthly
    sketches: history, then a refresh of the later months, then a roll-up of
    sketches.  The rank of each median is then counted in the facts."""
    from .operators.sketch import rank_error
    from .plans.sketches import median_prices, refresh_price_sketches

    path, keys = scratch_path(spark, "price_sketches"), ["broad_region", "property_type"]
    facts = writers.materialize(_g(spark, sf_dir).stg_transactions.select(
        month_start("transaction_date").alias("transaction_month"), "region", *keys, "price"), "sketch_facts")
    month = F.col("transaction_month")
    refresh_price_sketches(spark, path, facts.filter((month < F.lit("2000-01-01").cast("date")) & (F.col("price") % 3 != 0)))
    refresh_price_sketches(spark, path, facts.filter(month >= F.lit("1997-06-01").cast("date")))
    refresh_price_sketches(spark, path, facts.filter(month < F.lit("1997-06-01").cast("date")))
    medians = writers.materialize(median_prices(spark, path, keys), "sketch_medians")
    on = [medians[k].eqNullSafe(facts[k]) for k in keys]
    count = lambda c: F.count(F.when(c, 1))
    ranks = (facts.join(medians, on).groupBy(*[medians[k] for k in keys], "transaction_count", "median_price")
             .agg(F.count("price").alias("rows"), count(facts.price < F.col("median_price")).alias("below"),
                  count(facts.price <= F.col("median_price")).alias("up_to")))
    slack = F.col("rows") * F.lit(rank_error()) + 1
    return ranks.select(*keys, "transaction_count", (
        (F.col("below") <= F.col("rows") / 2 + slack) & (F.col("up_to") >= F.col("rows") / 2 - slack)).alias("within_bound"))
