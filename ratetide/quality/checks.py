"""Declarative data-quality checks evaluated as Spark aggregations.

``run_checks(df, checks)`` returns a DataFrame
``(check, column, evaluated, failed, success)``.  Every row-level check is a
pair of per-row 0/1 indicators (evaluated, failed) whose sums decide it, so
all checks of a table share **one** scan:

* without a uniqueness check: one global aggregation (partial per task);
* with one: the indicators ride along in the ``groupBy(column)`` the
  uniqueness check needs (partial aggregation per key, so a hot value is
  collapsed map-side), then a one-row sum.  Each further uniqueness check
  adds one group-by.

Nothing is collected except by ``gate``, which reads the result (one row per
check) and raises before a write.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DataQualityError(RuntimeError):
    def __init__(self, failures: list[dict]):
        self.failures = failures
        names = ", ".join(f"{f['check']}({f['column']})" for f in failures)
        super().__init__(f"data quality gate failed: {names}")


def _flag(cond: Column) -> Column:
    """1 where ``cond`` is true, else 0 (NULL counts as false)."""
    return F.when(F.coalesce(cond, F.lit(False)), 1).otherwise(0)


def _mostly_ok(failed: Column, evaluated: Column, mostly: float) -> Column:
    if mostly >= 1.0:
        return failed == 0
    share = F.try_divide((evaluated - failed).cast("double"), evaluated.cast("double"))
    return (evaluated == 0) | (share >= F.lit(mostly))


@dataclass(frozen=True)
class Check:
    """Base: ``name`` identifies the check kind in results."""

    column: str | None = None
    # "warn": reported by run_checks, never fails the gate
    severity: str = field(default="error", kw_only=True)

    @property
    def name(self) -> str:
        raise NotImplementedError

    def indicators(self, df: DataFrame) -> tuple[Column, Column]:
        """Per-row (evaluated, failed) 0/1 indicators."""
        raise NotImplementedError

    def outcome(self, df: DataFrame, evaluated: Column,
                failed: Column) -> tuple[Column, Column]:
        """(failed, success) from the summed indicators."""
        return failed, failed == 0

    def reported(self, evaluated: Column) -> Column:
        """The ``evaluated`` value shown in results."""
        return evaluated


@dataclass(frozen=True)
class ColumnExists(Check):
    name = "column_exists"

    def indicators(self, df):
        return F.lit(0), F.lit(0)

    def outcome(self, df, evaluated, failed):
        ok = self.column in df.columns
        return F.lit(0 if ok else 1).cast("bigint"), F.lit(ok)

    def reported(self, evaluated):
        return F.lit(1)  # one schema checked


@dataclass(frozen=True)
class NotNull(Check):
    name = "not_null"

    def indicators(self, df):
        return F.lit(1), _flag(F.col(self.column).isNull())


@dataclass(frozen=True)
class Between(Check):
    """Inclusive bounds, NULLs ignored; passes when the share of valid
    non-NULL values is at least ``mostly``."""

    min_value: object = None
    max_value: object = None
    mostly: float = 1.0
    name = "between"

    def indicators(self, df):
        c = F.col(self.column)
        bad = F.lit(False)
        if self.min_value is not None:
            bad = bad | (c < F.lit(self.min_value))
        if self.max_value is not None:
            bad = bad | (c > F.lit(self.max_value))
        return _flag(c.isNotNull()), _flag(c.isNotNull() & bad)

    def outcome(self, df, evaluated, failed):
        return failed, _mostly_ok(failed, evaluated, self.mostly)


@dataclass(frozen=True)
class AcceptedRange(Check):
    """min/max with an ``inclusive`` flag; NULLs pass."""

    min_value: object = None
    max_value: object = None
    inclusive: bool = True
    name = "accepted_range"

    def indicators(self, df):
        c = F.col(self.column)
        bad = F.lit(False)
        if self.min_value is not None:
            bad = bad | ((c < F.lit(self.min_value)) if self.inclusive
                         else (c <= F.lit(self.min_value)))
        if self.max_value is not None:
            bad = bad | ((c > F.lit(self.max_value)) if self.inclusive
                         else (c >= F.lit(self.max_value)))
        return F.lit(1), _flag(c.isNotNull() & bad)


@dataclass(frozen=True)
class InSet(Check):
    """Accepted values; NULLs pass."""

    values: tuple = ()
    mostly: float = 1.0
    name = "accepted_values"

    def indicators(self, df):
        c = F.col(self.column)
        return _flag(c.isNotNull()), _flag(c.isNotNull() & ~c.isin(*self.values))

    def outcome(self, df, evaluated, failed):
        return failed, _mostly_ok(failed, evaluated, self.mostly)


@dataclass(frozen=True)
class RowCountBetween(Check):
    min_value: int | None = None
    max_value: int | None = None
    name = "row_count_between"

    def indicators(self, df):
        return F.lit(1), F.lit(0)

    def outcome(self, df, evaluated, failed):
        ok = F.lit(True)
        if self.min_value is not None:
            ok = ok & (evaluated >= self.min_value)
        if self.max_value is not None:
            ok = ok & (evaluated <= self.max_value)
        return F.when(ok, 0).otherwise(1).cast("bigint"), ok


@dataclass(frozen=True)
class NoRowsWhere(Check):
    """A singular assertion: passes when no row matches ``predicate`` (a SQL
    expression string)."""

    predicate: str = "false"
    label: str = "no_rows"

    @property
    def name(self):
        return self.label

    def indicators(self, df):
        return F.lit(1), _flag(F.expr(self.predicate))


@dataclass(frozen=True)
class RowsPerFile(Check):
    """Rows of each landed file within bounds: a batch of many files may hold
    any number.  ``evaluated`` counts files, ``failed`` those out of bounds; a
    frame that is not read from files of one table has none."""

    min_value: int | None = None
    max_value: int | None = None
    name = "rows_per_file"

    def result(self, df: DataFrame, ord_: int) -> DataFrame:
        n = F.col("_n")
        bad = _flag((n < F.lit(self.min_value)) | (n > F.lit(self.max_value)))
        try:
            files = df.groupBy(F.input_file_name().alias("_file")).agg(F.count(F.lit(1)).alias("_n"))
        except AnalysisException as e:  # a frame joined of several tables: no landed files
            if e.getCondition() != "MULTI_SOURCES_UNSUPPORTED_FOR_EXPRESSION":
                raise
            files = df.sparkSession.createDataFrame([], "_n bigint")
        return files.agg(F.count(F.lit(1)).alias("ev"), F.coalesce(F.sum(bad), F.lit(0)).alias("fa")).select(
            F.inline(F.array(_result(ord_, self, F.col("ev"), F.col("fa"), F.col("fa") == 0))))


@dataclass(frozen=True)
class Unique(Check):
    """No duplicated non-NULL value; ``failed`` = rows holding a duplicate."""

    name = "unique"


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    return _run_checks(df, checks).drop("ord")


def _result(ord_: int, chk: Check, evaluated: Column, failed: Column,
            success: Column) -> Column:
    return F.struct(F.lit(ord_).alias("ord"), F.lit(chk.name).alias("check"),
                    F.lit(chk.column).cast("string").alias("column"),
                    evaluated.cast("bigint").alias("evaluated"),
                    failed.cast("bigint").alias("failed"), success.alias("success"))


def _sum0(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0)).alias(name)


def _run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """As ``run_checks`` plus ``ord``: the index of the check in ``checks``."""
    row = [(i, c) for i, c in enumerate(checks) if not isinstance(c, (Unique, RowsPerFile))]
    files = [(i, c) for i, c in enumerate(checks) if isinstance(c, RowsPerFile)]
    uniq = [(i, c) for i, c in enumerate(checks) if isinstance(c, Unique)]
    inds = []
    for i, c in row:
        e, f = c.indicators(df)
        inds += [e.alias(f"e{i}"), f.alias(f"f{i}")]
    sums = [f"{p}{i}" for i, _ in row for p in "ef"]

    def row_results() -> list[Column]:
        out = []
        for i, c in row:
            ev = F.col(f"e{i}")
            fa, ok = c.outcome(df, ev, F.col(f"f{i}"))
            out.append(_result(i, c, c.reported(ev), fa, ok))
        return out

    parts: list[DataFrame] = [c.result(df, i) for i, c in files]
    if uniq:
        # the first uniqueness check's group-by also carries the row checks
        i0, u0 = uniq[0]
        per_key = (df.select(F.col(u0.column).alias("_k"), *inds)
                   .groupBy("_k")
                   .agg(F.count(F.lit(1)).alias("_n"), *[F.sum(s).alias(s) for s in sums]))
        nn = F.col("_k").isNotNull()
        totals = per_key.agg(
            F.coalesce(F.sum(F.when(nn, F.col("_n"))), F.lit(0)).alias("_ue"),
            F.coalesce(F.sum(F.when(nn & (F.col("_n") > 1), F.col("_n"))), F.lit(0))
             .alias("_uf"),
            *[_sum0(s) for s in sums])
        first = _result(i0, u0, F.col("_ue"), F.col("_uf"), F.col("_uf") == 0)
        parts.append(totals.select(F.inline(F.array(first, *row_results()))))
        rest = uniq[1:]
    else:
        if row:
            totals = df.select(*inds).agg(*[_sum0(s) for s in sums])
            parts.append(totals.select(F.inline(F.array(*row_results()))))
        rest = []
    for i, chk in rest:
        counts = (df.filter(F.col(chk.column).isNotNull())
                    .groupBy(chk.column).agg(F.count(F.lit(1)).alias("n")))
        agg = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("ev"),
                         F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0))
                         .alias("fa"))
        parts.append(agg.select(F.inline(F.array(
            _result(i, chk, F.col("ev"), F.col("fa"), F.col("fa") == 0)))))
    return reduce(DataFrame.unionByName, parts)


def evaluate(df: DataFrame, checks: Sequence[Check]) -> tuple[list[dict], list[dict]]:
    """All results (one row per check), and the failed ones that are errors:
    checks of severity "warn" are reported only."""
    rows = [r.asDict() for r in _run_checks(df, checks).orderBy("ord").collect()]
    results = [{k: v for k, v in r.items() if k != "ord"} | {"severity": checks[r["ord"]].severity} for r in rows]
    return results, [r for r in results if not r["success"] and r["severity"] != "warn"]


def gate(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Raise ``DataQualityError`` if a check of severity "error" fails; otherwise
    return ``df`` unchanged so it can be written (``gate(df, suite).write...``)."""
    _, errors = evaluate(df, checks)
    if errors:
        raise DataQualityError(errors)
    return df


def newest_partition(df: DataFrame, partition_col: str = "run_date") -> DataFrame:
    """Restrict to the newest landed batch.  For landed folders
    (``run_date=...``) the newest is read off the file list and the filter
    prunes folders; other frames are aggregated."""
    found = {m[1] for f in df.inputFiles() if (m := re.search(rf"/{re.escape(partition_col)}=([^/]+)/", f))}
    if found:
        return df.filter(F.col(partition_col).cast("string") == F.lit(unquote(max(found))))
    latest = df.agg(F.max(partition_col).alias("_latest"))
    return df.join(F.broadcast(latest), F.col(partition_col) == F.col("_latest"),
                   "left_semi")
