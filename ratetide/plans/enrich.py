"""Intermediate model: transactions enriched with the rate and yield in force."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import month_start, parse_txn_date
from ..sinks.writers import materialize
from .rates import rate_for_month


def transaction_months(stg_txn: DataFrame) -> DataFrame:
    """Distinct months of staged transactions (one row per calendar month)."""
    return stg_txn.select(month_start("transaction_date").alias("transaction_month")).distinct()


def raw_transaction_months(raw: DataFrame) -> DataFrame:
    """Distinct months of *raw* rows: a superset of the staged months that
    needs one pruned column and no dedup shuffle.  A rate looked up for a
    month no staged row has is never joined, so results are unchanged."""
    m = month_start(parse_txn_date("transaction_date", strict=False))
    return (raw.select(m.alias("transaction_month"))
               .filter(F.col("transaction_month").isNotNull()).distinct())


def monthly_yields(stg_yields: DataFrame) -> DataFrame:
    """Monthly average of the daily yield series."""
    return (stg_yields.groupBy(month_start("date").alias("yield_month"))
                      .agg(F.avg("yield_pct").alias("avg_yield_pct")))


def int_transactions_with_rates(stg_txn: DataFrame, reconciled: DataFrame,
                                stg_yields: DataFrame,
                                months: DataFrame | None = None) -> DataFrame:
    """Each staged transaction with the month's policy rate (as-of, month
    grain) and the month's average yield.

    The as-of lookup runs on distinct months only (``months``: any superset
    of the transaction months, default derived from ``stg_txn``); the fact
    side then needs two equi-joins against month-grain tables.  Those are
    bounded by the calendar (12 rows a year).  The context is written once;
    its file size then lets ``spark.sql.autoBroadcastJoinThreshold`` decide, in
    bytes and before the fact side is shuffled.
    """
    if months is None:
        months = transaction_months(stg_txn)
    rfm = rate_for_month(months, "transaction_month", reconciled)
    yields = monthly_yields(stg_yields).withColumnRenamed("yield_month", "transaction_month")
    # one month-grain context (rfm covers every transaction month): written
    # once, joined once to the fact rows
    ctx = materialize(rfm.join(yields, "transaction_month", "left"), "month_ctx")
    t = stg_txn.withColumn("transaction_month", month_start("transaction_date"))
    joined = t.join(ctx, "transaction_month", "left")
    return joined.select(
        "transaction_id", "price", "transaction_date", "transaction_month", "postcode",
        "property_type", "old_new", "duration", "town_city", "region", "broad_region",
        "base_rate", F.col("avg_yield_pct").alias("gilt_yield_pct"),
    )
