"""Incremental maintenance of the monthly mart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.publish import recover
from ..sinks.writers import has_data, merge_upsert
from .marts import MONTHLY_COLUMNS, monthly_transactions_by_region

MONTHLY_KEYS = ["month", "region", "property_type"]


def incremental_cutoff(spark: SparkSession, target_path: str, month_col: str = "month",
                       overlap_months: int = 1) -> dt.date | None:
    """First month to reprocess: ``max(month) - overlap`` of the target, as a
    literal (so the downstream filter prunes statically).  ``None`` when the
    target is missing or holds no rows, which means a full load (the reference's
    NULL cutoff would load nothing)."""
    recover(spark, target_path)
    if not has_data(spark, target_path):
        return None
    row = (spark.read.parquet(target_path)
           .agg(F.trunc(F.add_months(F.max(month_col), -int(overlap_months)), "MM")
                .alias("c")).first())
    return row["c"] if row else None


def run_monthly_incremental(spark: SparkSession, enriched_fn, target_path: str,
                            overlap_months: int = 1, replace_months: bool = False,
                            accuracy: int = 10000) -> dt.date | None:
    """One incremental run of the monthly mart.

    ``enriched_fn(since)`` returns the enriched transactions restricted to
    months ``>= since`` (``None``: all) so the restriction can be applied as
    early as the caller's plan allows (see ``stg_transactions(since=...)``).
    Groups of the reprocessed months are upserted on (month, region,
    property_type) with null-safe keys; other months are never read or
    rewritten.  Returns the cutoff used.
    """
    cutoff = incremental_cutoff(spark, target_path, "month", overlap_months)
    src: DataFrame = enriched_fn(cutoff)
    if cutoff is not None:
        src = src.filter(F.col("transaction_month") >= F.lit(cutoff))
    delta = monthly_transactions_by_region(src, accuracy).select(*MONTHLY_COLUMNS)
    merge_upsert(spark, target_path, delta, MONTHLY_KEYS, partition_col="month",
                 replace_partitions=replace_months, cluster_cols=["region", "property_type"],
                 since=cutoff)
    return cutoff
