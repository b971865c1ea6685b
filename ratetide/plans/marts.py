"""Mart models: monthly aggregates, lagged rate context, regional sensitivity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import concat_key, property_type_label, safe_corr, safe_divide
from ..functions.fixed_values import CATCH_ALL_REGION
from ..operators.calendar import calendar_lag
from .rates import rate_for_month

MONTHLY_GRAIN = ["month", "region", "broad_region", "property_type"]
MONTHLY_COLUMNS = MONTHLY_GRAIN + [
    "transaction_count", "avg_price", "median_price", "min_price", "max_price",
    "avg_base_rate", "avg_gilt_yield_pct", "month_region_key",
]


def monthly_transactions_by_region(enriched: DataFrame, accuracy: int = 10000) -> DataFrame:
    """Volume and price statistics per month x county x property type.

    All aggregates are mergeable (``percentile_approx`` is a sketch), so the
    shuffle carries partial aggregates only: at most groups x map tasks rows,
    however skewed a county is.  ``month_region_key`` is month_region_type and
    NULL when region or type is NULL.
    """
    agg = (enriched.groupBy(F.col("transaction_month").alias("month"), "region",
                            "broad_region", "property_type")
           .agg(F.count(F.lit(1)).alias("transaction_count"),
                F.avg("price").alias("avg_price"),
                F.percentile_approx("price", 0.5, accuracy).alias("median_price"),
                F.min("price").alias("min_price"),
                F.max("price").alias("max_price"),
                F.avg("base_rate").alias("avg_base_rate"),
                F.avg("gilt_yield_pct").alias("avg_gilt_yield_pct")))
    return agg.withColumn("month_region_key", concat_key("month", "region", "property_type"))


def rate_context(months: DataFrame, month_col: str, reconciled: DataFrame,
                 lags: Sequence[int] = (1, 2, 3, 6)) -> DataFrame:
    """Per month: the rate in force (as-of by aggregate: months before the
    first rate are absent) and the rates N calendar months earlier.  Bounded
    by the number of distinct months."""
    ram = rate_for_month(months.select(F.col(month_col).alias("month")).distinct(), "month",
                         reconciled, how="inner")
    return calendar_lag(ram, "month", "base_rate", lags, name=lambda n: f"rate_lag_{n}m")


def rate_lag_analysis(monthly: DataFrame, reconciled: DataFrame,
                      lags: Sequence[int] = (1, 2, 3, 6), months: DataFrame | None = None) -> DataFrame:
    """Monthly aggregates with the rate at the month and at 1/2/3/6 calendar
    months before it, and the changes over those spans.  The context table is
    month-grain (bounded by the calendar) and joined once.  Both sides are
    aggregates here (no fact rows), so no hint is given: AQE picks a
    broadcast from the measured runtime sizes and falls back to a
    sort-merge join beyond its threshold.

    ``monthly`` is read twice (rows and distinct months): pass the written
    mart (``ModelGraph.monthly_table``, the runner's table), not a lazy plan
    over the facts, or the fact-side work runs twice.  ``months`` (column
    month) gives all months of the mart where ``monthly`` holds some only."""
    ctx = rate_context(monthly if months is None else months, "month", reconciled, lags)
    joined = monthly.join(ctx, "month", "left")
    lag_cols = [F.col(f"rate_lag_{n}m") for n in lags]
    change_cols = [(F.col("base_rate") - F.col(f"rate_lag_{n}m")).alias(f"rate_change_{n}m")
                   for n in lags]
    return joined.select(
        "month", "region", "broad_region", "property_type",
        property_type_label("property_type").alias("property_type_label"),
        "transaction_count", "avg_price", "median_price", "min_price", "max_price",
        F.col("base_rate").alias("rate_at_month"), *lag_cols, *change_cols,
    )


def sensitivity_steps(lag: DataFrame,
                      property_types: Sequence[str] = ("D", "S", "T", "F"),
                      exclude_region: str = CATCH_ALL_REGION):
    """The intermediate frames of the sensitivity model, in order:
    ``broad`` (counties rolled up to broad regions), ``smoothed`` (3-row
    rolling mean over *all* months) and ``with_pct`` (months with a 1-month
    rate change only, then the 3-row lag of the rolling mean, so the lag
    counts surviving rows).  Windows are partitioned by (broad_region,
    property_type): one partition per series, each bounded by the number of
    months."""
    lag_data = lag.filter(F.col("property_type").isin(*property_types)
                          & (F.col("broad_region") != exclude_region))
    broad = (lag_data.groupBy("month", "broad_region", "property_type",
                              "rate_change_1m", "rate_change_3m")
             .agg(F.sum("transaction_count").alias("transaction_count")))
    series = ["broad_region", "property_type"]
    by_month = Window.partitionBy(*series).orderBy("month", "rate_change_1m", "rate_change_3m")
    smoothed = broad.withColumn(
        "rolling_3m_avg_txns",
        F.avg("transaction_count").over(by_month.rowsBetween(-2, Window.currentRow)))
    kept = smoothed.filter(F.col("rate_change_1m").isNotNull())
    prev3 = F.lag("rolling_3m_avg_txns", 3).over(by_month)
    with_pct = kept.withColumn(
        "pct_vol_change_3m", safe_divide(F.col("rolling_3m_avg_txns") - prev3, prev3) * 100)
    return broad, smoothed, with_pct


def regional_sensitivity(lag: DataFrame, min_months: int = 12,
                         property_types: Sequence[str] = ("D", "S", "T", "F"),
                         exclude_region: str = CATCH_ALL_REGION) -> DataFrame:
    """Rank broad regions x property types by how volumes move after rate changes.

    Order of steps matters (see ``sensitivity_steps``): roll up, smooth over
    all months, drop months without a 1-month change, lag 3 surviving rows;
    then drop NULL changes, require ``min_months`` observations and score
    from unrounded averages (NULL when a series never saw a hike or a cut).
    """
    series = ["broad_region", "property_type"]
    with_pct = sensitivity_steps(lag, property_types, exclude_region)[2]
    pct = F.col("pct_vol_change_3m")
    sens = (with_pct.filter(pct.isNotNull())
            .groupBy(*series)
            .agg(F.count(F.lit(1)).alias("months_observed"),
                 F.avg(pct).alias("avg_pct"),
                 safe_corr("rate_change_3m", pct).alias("corr"),
                 F.avg(F.when(F.col("rate_change_1m") > 0, pct)).alias("hike"),
                 F.avg(F.when(F.col("rate_change_1m") < 0, pct)).alias("cut"))
            .filter(F.col("months_observed") >= min_months))
    return (sens.select(
                *series, "months_observed",
                F.round("avg_pct", 2).alias("avg_pct_vol_change_3m"),
                F.round("corr", 4).alias("rate_volume_correlation"),
                F.round("hike", 2).alias("avg_vol_change_after_hike"),
                F.round("cut", 2).alias("avg_vol_change_after_cut"),
                F.round(F.abs(F.col("hike") - F.col("cut")) / 2, 2).alias("sensitivity_score"))
            .orderBy(F.col("sensitivity_score").desc_nulls_last(), *series))
