"""Dimension bucketing: map a free-text code to a bucket with a catch-all."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import normalize_key
from ..functions.fixed_values import CATCH_ALL_REGION


def bucket_dimension(df: DataFrame, source_col: str | Column, mapping, out_col: str,
                     default: str = CATCH_ALL_REGION, map_key: str = "key",
                     map_value: str = "value") -> DataFrame:
    """Add ``out_col`` = bucket of ``upper(trim(source_col))``; unmatched and
    NULL go to ``default``.

    ``mapping`` is either a dict (a fixed list, e.g. the county map: becomes a
    literal map lookup inside the projection, no join) or a DataFrame with
    ``map_key``/``map_value`` (a data-driven dimension: deduplicated on the
    key and joined; Spark's size estimate picks the join).
    """
    key = normalize_key(source_col if isinstance(source_col, Column) else F.col(source_col))
    if isinstance(mapping, dict):
        lit_map = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
        return df.withColumn(out_col, F.coalesce(F.try_element_at(lit_map, key), F.lit(default)))
    dim = (mapping.groupBy(F.col(map_key).alias("_bk"))
                  .agg(F.min(F.col(map_value)).alias("_bv")))
    joined = df.join(dim, key == F.col("_bk"), "left")
    return (joined.withColumn(out_col, F.coalesce(F.col("_bv"), F.lit(default)))
                  .drop("_bk", "_bv"))


def county_lookup() -> dict[str, str]:
    from ..functions.fixed_values import county_map_rows

    return dict(county_map_rows())
