"""Exact discrete median per group, without a group in one buffer."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sinks.writers import materialize


def exact_median(df: DataFrame, keys: Sequence[str], value: str, width: int = 1024,
                 out: str = "median") -> DataFrame:
    """The smallest value that half of a group's non-NULL values do not exceed
    (``percentile_disc(0.5)``), per ``keys``; NULL keys are a group.

    Rows are counted per value and per range of ``width`` values; the ranges'
    running totals tell which range holds the middle row, and only that range
    is ordered value by value.  Counts combine map-side, so a hot group costs
    its number of distinct values, and no task sees more of a group than its
    ranges or one range.
    """
    keys = list(keys)
    counts = (df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v"))
              .agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_range", F.floor(F.col("_v") / F.lit(width))))
    counts = materialize(counts, "median_counts")
    group = Window.partitionBy(*keys)
    ranges = (counts.groupBy(*keys, "_range").agg(F.sum("_n").alias("_in"))
              .withColumn("_upto", F.sum("_in").over(group.orderBy("_range")))
              .withColumn("_middle", F.ceil(F.sum("_in").over(group) / 2)))
    holding = (ranges.filter((F.col("_upto") >= F.col("_middle"))
                             & (F.col("_upto") - F.col("_in") < F.col("_middle")))
               .select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_range").alias("_r"),
                       (F.col("_upto") - F.col("_in")).alias("_before"), "_middle"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys],
                  F.col("_range") == F.col("_r"))
    inside = counts.join(holding, same).withColumn(
        "_upto", F.col("_before") + F.sum("_n").over(group.orderBy("_v")))
    return (inside.filter(F.col("_upto") >= F.col("_middle"))
            .groupBy(*keys).agg(F.min("_v").alias(out)))
