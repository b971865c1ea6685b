"""Row-level quarantine: which checks a row fails, and tables split into good and
bad rows.

Checks of single rows are judged where the row is read.  A uniqueness check needs
the duplicated values: they are counted (partially aggregated, so a hot value
costs a row per task) and written once, and a broadcast bitmap of them picks the
rows that may hold one.  Only those are joined with the values; all other rows
are never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.prefilter import mark_few
from ..sinks.writers import materialize
from .checks import Check, ColumnExists, RowCountBetween, RowsPerFile, Unique

FAILED = "failed_checks"


def judges_rows(check: Check) -> bool:
    """Does the check tell good rows from bad ones?  The others judge a table."""
    return not isinstance(check, (ColumnExists, RowCountBetween, RowsPerFile))


def sends_away(check: Check) -> bool:
    """Is a row that fails the check bad?  Not if the check only warns, nor if it
    tolerates a share of such rows (``mostly``): that is a matter of the table."""
    return judges_rows(check) and check.severity != "warn" and getattr(check, "mostly", 1.0) >= 1.0


def label(check: Check) -> str:
    return f"{check.name}({check.column})"


def _with_duplicates(df: DataFrame, column: str, out: str) -> DataFrame:
    """``df`` with a flag ``out``: the value of ``column`` is held by several rows.
    NULL is no value."""
    values = df.groupBy(F.col(column).alias(out)).agg(F.count(F.lit(1)).alias("_n"))
    twice = materialize(values.filter((F.col("_n") > 1) & F.col(out).isNotNull()).select(out), "duplicated")
    likely = mark_few(df, twice.withColumnRenamed(out, column), column, "_likely")
    some = (likely.filter("_likely").drop("_likely").join(twice, F.col(column) == F.col(out), "left")
            .withColumn(out, F.col(out).isNotNull()))
    rest = likely.filter("NOT _likely").drop("_likely").withColumn(out, F.lit(False))
    return rest.unionByName(some)


def mark_rows(df: DataFrame, checks: Sequence[Check], out: str = FAILED) -> DataFrame:
    """``df`` with an array ``out``: the labels ``check(column)`` of the given checks
    that the row fails, in their order; empty for a good row.  Checks of whole
    tables are passed over.  Rows are kept as they are, repeated ones too; NULLs
    count as in ``run_checks``.  ``df`` is read up to three times for each
    uniqueness check: pass a table or landed files.  ``out`` must be a new name."""
    if out in df.columns:
        raise ValueError(f"column {out} exists already")
    flags: list[Column] = []
    marked, helpers = df, []
    for i, check in enumerate(c for c in checks if judges_rows(c)):
        if isinstance(check, Unique):
            helpers.append(f"_twice{i}")
            marked = _with_duplicates(marked, check.column, helpers[-1])
            bad = F.col(helpers[-1])
        else:
            bad = check.indicators(df)[1] == 1
        flags.append(F.when(bad, F.lit(label(check))))
    failed = F.array_compact(F.array(*flags)) if flags else F.array().cast("array<string>")
    return marked.withColumn(out, failed).drop(*helpers)


def split_rows(df: DataFrame, checks: Sequence[Check], out: str = FAILED) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with ``out``).  Bad is a row that fails a check of
    severity "error" without a tolerance; ``out`` lists all such checks."""
    marked = mark_rows(df, [c for c in checks if sends_away(c)], out)
    return marked.filter(F.size(out) == 0).drop(out), marked.filter(F.size(out) > 0)
