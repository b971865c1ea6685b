"""Latest-wins deduplication (one row per key)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _sort_expr(o: str | Column) -> Column:
    return F.col(o).desc_nulls_last() if isinstance(o, str) else o


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                 tie_break: Sequence[str] | None = None) -> DataFrame:
    """Keep the first row per ``keys`` when rows are ranked by ``order``.

    ``order`` items that are column names rank newest-first (DESC NULLS LAST);
    pass a sort ``Column`` for anything else (e.g. a priority).  Ties are
    broken by ``tie_break`` (default: every remaining column, DESC NULLS
    LAST), so the kept row never depends on file or task order.

    Plan: one hash exchange on ``keys`` and a sort inside each partition.
    ``row_number() = 1`` lets Catalyst insert a partial ``WindowGroupLimit``
    before the exchange, so each map task forwards at most one row per key:
    a hot key (e.g. NULL ids) ships one row per task, not all its rows.
    """
    keys = list(keys)
    named = {o for o in order if isinstance(o, str)}
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in keys and c not in named]
    ranking = [_sort_expr(o) for o in order] + [F.col(c).desc_nulls_last() for c in tie_break]
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*ranking)
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1)
              .drop("_rn"))


def dedup_latest_few(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``dedup_latest`` by column names for few keys of many rows each (a series):
    rows are sorted by key only and reduced to one a key and task before the
    shuffle.  The order of structs is that of DESC NULLS LAST on their fields."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in order]
    newest = F.max(F.struct(*order, *rest)).alias("_newest")
    picked = [F.col(c) if c in keys else F.col("_newest")[c].alias(c) for c in df.columns]
    return df.groupBy(*keys).agg(newest).select(*picked)
