"""Mergeable quantile state: a KLL sketch of a bigint column per group.

A sketch holds some ``3 * k`` values at any number of rows.  Sketches of parts
merge into the sketch of the whole, so roll-ups and refreshed parts need no fact
again.  Up to ``k`` values a sketch is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size parameter of the sketches; all sketches that meet must share it.
K = 800


def rank_error(k: int = K) -> float:
    """Bound of the error of a rank, as a share of the rows: three times
    2.296 / k**0.9021, the fit that the sketch's library documents for 99 % of
    single queries."""
    return 3 * 2.296 / k ** 0.9021


def sketch_groups(df: DataFrame, keys: Sequence[str], value: str, k: int = K, out: str = "sketch") -> DataFrame:
    """One sketch of ``value`` (NULLs left out) per group: partial sketches are
    built in the map tasks, so a hot group ships one per task."""
    return df.groupBy(*keys).agg(F.kll_sketch_agg_bigint(F.col(value).cast("bigint"), F.lit(k)).alias(out))


def merge_groups(sketches: DataFrame, keys: Sequence[str], sketch: str = "sketch", k: int = K) -> DataFrame:
    """Sketches merged to coarser groups."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_bigint(F.col(sketch), F.lit(k)).alias(sketch))


def sketch_rows(sketch: str = "sketch") -> Column:
    """Number of values in a sketch."""
    return F.kll_sketch_get_n_bigint(F.col(sketch))


def sketch_quantile(rank: float = 0.5, sketch: str = "sketch") -> Column:
    """The value at ``rank``; NULL for a sketch of no values."""
    return F.when(sketch_rows(sketch) > 0, F.kll_sketch_get_quantile_bigint(F.col(sketch), F.lit(rank)))
