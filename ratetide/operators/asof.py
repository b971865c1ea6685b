"""As-of lookups: the latest series value at or before each probe key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ranges import OrderedRanges


def asof_lookup(probe: DataFrame, probe_col: str, series: DataFrame, series_col: str,
                value_col: str, order: Sequence[str] = (), how: str = "left",
                partition_by: Sequence[str] = (), out_col: str | None = None,
                ranges: int | None = None) -> DataFrame:
    """For each distinct probe key ``p`` return the value of the series row with
    the greatest ``(series_col, *order)`` such that ``series_col <= p``.

    ``how='left'`` keeps probe keys with no earlier series row (value NULL);
    ``how='inner'`` drops them.  Rows of the series that tie on ``series_col``
    are ranked by ``order`` ascending, so the last of them wins.

    Plan: no join at all.  Probe keys and series rows are unioned and one
    window (ordered by key, series rows first on equal keys) carries the last
    series value forward; a struct is carried so a NULL series value is
    carried as NULL rather than skipped.  The window is partitioned by
    ``partition_by`` (one series per partition key).  With no partition key it
    runs in one task, which suits bounded calendars (one row per distinct
    month or day); for longer ones ``ranges`` (0: by their number of rows) deals
    the rows by ranges of the key and carries values over (``OrderedRanges``).
    """
    out_col = out_col or value_col
    parts = [F.col(c) for c in partition_by]
    # a NULL series key matches no probe key (as in a `>=` join condition)
    s = series.filter(F.col(series_col).isNotNull()).select(
        *parts,
        F.col(series_col).alias("_k"),
        F.lit(0).alias("_t"),
        *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)],
        F.struct(F.col(value_col).alias("v")).alias("_v"),
    )
    p = (probe.select(*parts, F.col(probe_col).alias("_k")).distinct()
         .withColumn("_t", F.lit(1)))
    u = s.unionByName(p, allowMissingColumns=True)
    along = ["_k", "_t", *[f"_o{i}" for i in range(len(order))]]
    if ranges is not None:
        if parts:
            raise ValueError("ranges are for a series without a partition key")
        u = OrderedRanges(u, along, ranges or None).last_value("_v", "_c")
    else:
        w = (Window.partitionBy(*parts).orderBy(*along)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        u = u.withColumn("_c", F.last("_v", ignorenulls=True).over(w))
    res = u.filter(F.col("_t") == 1)
    if how == "inner":
        res = res.filter(F.col("_c").isNotNull())
    elif how != "left":
        raise ValueError(f"how must be 'left' or 'inner', got {how!r}")
    return res.select(*parts, F.col("_k").alias(probe_col), F.col("_c.v").alias(out_col))


def step_intervals(series: DataFrame, start_col: str, order: Sequence[str] = (),
                   end_col: str = "next_change", ranges: int | None = None) -> DataFrame:
    """``lead(start)`` over the series: each row's validity ``[start, next)``;
    the last row is open-ended (NULL).  One task for a bounded series (one row
    per date); ``ranges`` as in ``asof_lookup``."""
    if ranges is not None:
        return OrderedRanges(series, [start_col, *order], ranges or None).lead(start_col, end_col)
    w = Window.orderBy(F.col(start_col), *[F.col(o) for o in order])
    return series.withColumn(end_col, F.lead(start_col).over(w))
