"""Calendar periods as partitions of a table: one folder a month while few months
are held, longer periods of equal length once there are more.

A folder costs several file operations in every write, listing and publish, so a
table by month slows down with the span of its dates.  Where a table would hold
more than ``MOST_FOLDERS`` periods their length doubles, as often as needed, and
the table is rewritten once.  The length lies in the table's own folder, as an
empty file ``_period_months.<n>``, so it comes and goes with the rows.  A table
without one is by month.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.publish import publish_table
from ..sinks.writers import _fs

MOST_FOLDERS = 64
_MARK = "_period_months."  # no "=": Spark reads such files


def month_number(date_col: str) -> Column:
    """Months since January of year 1."""
    return (F.year(date_col) - 1) * 12 + F.month(date_col) - 1


def period_start(date_col: str, width: int) -> Column:
    """First day of the period of ``width`` months that holds the date."""
    first = month_number(date_col)
    first = first - F.pmod(first, F.lit(width))
    return F.make_date(F.floor(first / 12).cast("int") + 1, F.pmod(first, F.lit(12)) + 1, F.lit(1))


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def table_width(spark: SparkSession, path: str) -> int:
    """Months of a period of the table at ``path``."""
    return next((int(n.removeprefix(_MARK)) for n in _names(spark, path) if n.startswith(_MARK)), 1)


def _held_months(spark: SparkSession, path: str, col: str) -> set[int]:
    """Numbers of the first months of the periods that the table has folders of."""
    values = [unquote(n.removeprefix(f"{col}=")) for n in _names(spark, path) if n.startswith(f"{col}=")]
    days = [dt.date.fromisoformat(v) for v in values if v[:1].isdigit()]
    return {(d.year - 1) * 12 + d.month - 1 for d in days}


def fitting_width(spark: SparkSession, path: str, col: str, rows: DataFrame, date_col: str = "effective_date") -> int:
    """The length of a period at which the table has at most ``MOST_FOLDERS`` of
    them once it holds ``rows``; never less than it has now."""
    # months of the calendar, so few
    months = [r[0] for r in rows.select(month_number(date_col).alias("m")).distinct().collect() if r[0] is not None]
    held = {*months, *_held_months(spark, path, col)}
    width = table_width(spark, path)
    while len({m // width for m in held}) > MOST_FOLDERS:
        width *= 2
    return width


def publish_periods(spark: SparkSession, rows: DataFrame, path: str, width: int, col: str,
                    cluster_cols: Sequence[str] = (), split_cols: Sequence[str] = ()) -> None:
    """Replace the whole table by ``rows``, whose ``col`` is a period of ``width``
    months; rows and length become visible in one step."""
    publish_table(spark, rows, path, col, cluster_cols, split_cols, marks=[f"{_MARK}{width}"])


def in_periods(periods: Iterable, col: str) -> Column:
    """Condition that ``col`` is one of the periods (null too); prunes folders."""
    periods = list(periods)
    known = [F.lit(p) for p in periods if p is not None]
    inside = F.col(col).isin(*known) if known else F.lit(False)
    return inside | F.col(col).isNull() if None in periods else inside
