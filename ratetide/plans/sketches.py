"""Stored price sketches: one per month, county and property type.

The table is partitioned by month and refreshed like the monthly mart: months in
which facts changed are sketched anew, others keep their files.  Medians of any
coarser group (broad regions, years, all months) come from merged sketches; no
fact is read for them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.sketch import K, merge_groups, sketch_groups, sketch_quantile, sketch_rows
from ..sinks.publish import recover
from ..sinks.writers import merge_upsert
from .marts import MONTHLY_GRAIN


def price_sketches(facts: DataFrame, k: int = K) -> DataFrame:
    """Sketches of ``price`` at the monthly mart's grain."""
    return sketch_groups(facts.withColumnRenamed("transaction_month", "month"), MONTHLY_GRAIN, "price", k)


def refresh_price_sketches(spark: SparkSession, path: str, facts: DataFrame, k: int = K) -> None:
    """Replace the sketches of the months that ``facts`` holds: all facts of those
    months must be in it (a sketch forgets no row).  A rerun gives the same table."""
    merge_upsert(spark, path, price_sketches(facts, k), MONTHLY_GRAIN, partition_col="month",
                 replace_partitions=True, cluster_cols=["region", "property_type"])


def median_prices(spark: SparkSession, path: str, keys: Sequence[str], k: int = K) -> DataFrame:
    """Rows and median price of each group of ``keys``, columns of the grain."""
    recover(spark, path)
    merged = merge_groups(spark.read.parquet(path), keys, k=k)
    return merged.select(*keys, sketch_rows().alias("transaction_count"), sketch_quantile().alias("median_price"))
