"""Change detection over an ordered series (batch twin of the streaming one)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ranges import OrderedRanges


def detect_changes(series: DataFrame, order_col: str, value_col: str,
                   partition_by: Sequence[str] = (), prev_col: str = "previous_rate",
                   emit_first: bool = True, ranges: int | None = None) -> DataFrame:
    """Rows whose value differs from the previous row's value.

    ``emit_first`` keeps the first row of a series (no previous state -> an
    event with ``prev_col`` NULL), as change publication does on a first run.
    Partitioned by ``partition_by``; without it the window is one task, for a
    bounded series (one row per date).  ``ranges`` deals a longer one by ranges
    of ``order_col`` (0: by its number of rows), see ``OrderedRanges``.
    """
    if ranges is not None:
        if partition_by:
            raise ValueError("ranges are for a series without a partition key")
        out = OrderedRanges(series, [order_col], ranges or None).lag(value_col, prev_col)
    else:
        w = Window.partitionBy(*[F.col(c) for c in partition_by]).orderBy(F.col(order_col))
        out = series.withColumn(prev_col, F.lag(F.col(value_col)).over(w))
    cond = F.col(prev_col).isNull() if emit_first else F.lit(False)
    return out.filter(cond | (F.col(prev_col) != F.col(value_col)))
