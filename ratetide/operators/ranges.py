"""Lag, lead and last value over one long ordered series, range by range.

A window without a partition key runs in one task.  Here the rows are dealt by
ranges of the order instead, each range is worked on alone, and a small table
with a row per range (its last or first values) carries over what a range needs
from the ones before or after it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sinks.writers import materialize

ROWS = 1 << 18  # rows of a range, about


class OrderedRanges:
    """``df`` dealt by ranges of ``order`` (columns, ascending, nulls first).

    The rows are written once, one range a file, so that both passes see the
    same ranges, also after an executor is lost.  Rows that tie on all of
    ``order`` stay in one range.  ``ranges`` defaults to one for about ``ROWS``
    rows."""

    def __init__(self, df: DataFrame, order: Sequence[str], ranges: int | None = None):
        self.order, self.columns = list(order), df.columns
        df = materialize(df, "ranges_in")  # the boundaries are sampled in a pass of their own
        n = ranges or max(1, -(-df.count() // ROWS))
        dealt = df.repartitionByRange(n, *(F.col(c).asc_nulls_first() for c in self.order))
        self.rows = materialize(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
        self.within = Window.partitionBy("_range").orderBy(*(F.col(c).asc_nulls_first() for c in self.order))

    def _carried(self, value: Column, first: bool) -> DataFrame:
        """(_range, _edge): the value at the near end of the nearest range before
        (``first``: after) each range that has rows; one row per range."""
        at = F.struct(*(F.col(c).alias(f"o{i}") for i, c in enumerate(self.order)), value.alias("v"))
        pick = F.min(at) if first else F.max(at)
        ends = self.rows.groupBy("_range").agg(pick.alias("end"))
        step = Window.orderBy("_range")  # a row per range
        near = F.lead("end.v").over(step) if first else F.lag("end.v").over(step)
        return ends.select("_range", F.struct(near.alias("v")).alias("_edge"))

    def _with(self, name: str, value: Column, inside: Column, edge: Column, first: bool) -> DataFrame:
        carried = self._carried(value, first)
        joined = self.rows.join(carried, "_range")
        return joined.withColumn(name, F.when(edge, F.col("_edge.v")).otherwise(inside)).select(*self.columns, name)

    def lag(self, value_col: str, name: str) -> DataFrame:
        """The rows with the value of the row before."""
        first = F.row_number().over(self.within) == 1
        return self._with(name, F.col(value_col), F.lag(value_col).over(self.within), first, first=False)

    def lead(self, value_col: str, name: str) -> DataFrame:
        """The rows with the value of the row after."""
        inside = F.lead(F.struct(F.col(value_col).alias("v"))).over(self.within)
        return self._with(name, F.col(value_col), inside["v"], inside.isNull(), first=True)

    def last_value(self, value_col: str, name: str) -> DataFrame:
        """The rows with the last non-null value up to and including them."""
        upto = self.within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        inside = F.last(value_col, ignorenulls=True).over(upto)
        # the last value of each range, then of the ranges before it
        keys = [F.col(c).alias(f"o{i}") for i, c in enumerate(self.order)]
        at = F.when(F.col(value_col).isNotNull(), F.struct(*keys, F.col(value_col).alias("v")))
        ends = self.rows.groupBy("_range").agg(F.max(at).alias("end"))
        before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        carried = ends.select("_range", F.last("end", ignorenulls=True).over(before).alias("_edge"))
        joined = self.rows.join(carried, "_range")
        return joined.withColumn(name, F.coalesce(inside, F.col("_edge.v"))).select(*self.columns, name)
