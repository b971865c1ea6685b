"""Change-driven refresh of the marts: only the months that changed are rebuilt,
whatever their age.

Dirty months come from staging (rows that came, changed or went) and from the
month context: the rate in force and the average yield of each staged month,
stored as a table of the last refresh and compared with the present one, so a
revised rate dirties the months it governs.  A month of the lag mart depends on
the monthly mart's month and on the rates up to the longest lag before it, so
its dirty months are closed over the lags.  The sensitivity ranking, one row per
region and type, is made anew when any lag month was.

The context is stored last: a refresh that is lost half-way finds the same
months dirty again.  Lists of months are bounded by the calendar.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.publish import publish_partitions
from ..sinks.writers import _fs, has_data, write_partitioned
from . import enrich, marts
from .rates import rate_for_month

CLUSTER = ["region", "property_type"]


def partition_months(spark: SparkSession, path: str) -> list[dt.date]:
    """Months of a table partitioned by month, off its folder names."""
    fs, root = _fs(spark, path)
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    values = [unquote(n.split("=", 1)[1]) for n in names if "=" in n]
    return sorted(dt.date.fromisoformat(v) for v in values if v[:1].isdigit())


def add_months(month: dt.date, n: int) -> dt.date:
    at = month.year * 12 + month.month - 1 + n
    return dt.date(at // 12, at % 12 + 1, 1)


class PendingMonths:
    """Months that staging rewrote and no refresh has taken up yet, kept below
    ``out_root`` as one small file per load."""

    def __init__(self, spark: SparkSession, out_root: str):
        self.spark, self.path = spark, f"{out_root}/pending_months"

    def add(self, months: Iterable[dt.date] | None) -> None:
        value = "all" if months is None else ",".join(m.isoformat() for m in months)
        self.spark.createDataFrame([(value,)], "value string").coalesce(1).write.mode("append").text(self.path)

    def months(self) -> set[dt.date] | None:
        """``None``: all."""
        if not has_data(self.spark, self.path):
            return set()
        found = {m for r in self.spark.read.text(self.path).collect() for m in r.value.split(",") if m}
        return None if "all" in found else {dt.date.fromisoformat(m) for m in found}

    def clear(self) -> None:
        fs, path = _fs(self.spark, self.path)
        fs.delete(path, True)


class MartRefresh:
    """Refresh of the tables below ``out_root`` after staging."""

    def __init__(self, spark: SparkSession, out_root: str, reconciled: DataFrame, yields: DataFrame,
                 lags: Sequence[int] = (1, 2, 3, 6)):
        self.spark, self.root, self.reconciled, self.yields, self.lags = spark, out_root, reconciled, yields, tuple(lags)
        self.staged, self.mart, self.lagged = (f"{out_root}/{t}" for t in (
            "stg_transactions", "monthly_transactions_by_region", "rate_lag_analysis"))
        self.monthly_months: set[dt.date] = set()
        self.lag_months: set[dt.date] = set()

    def _frame(self, months: Iterable[dt.date], name: str) -> DataFrame:
        return self.spark.createDataFrame([(m,) for m in sorted(months)], f"{name} date")

    # ---- month context
    def context(self, months: Iterable[dt.date]) -> dict[str, list]:
        """{month: [rate, yield]} as stored; yields to 12 digits, as their sums depend on the order."""
        frame = self._frame(months, "transaction_month")
        rates = rate_for_month(frame, "transaction_month", self.reconciled)
        yields = enrich.monthly_yields(self.yields).withColumnRenamed("yield_month", "transaction_month")
        rows = rates.join(yields, "transaction_month", "left").collect()
        return {r.transaction_month.isoformat(): [r.base_rate, None if r.avg_yield_pct is None else float(f"{r.avg_yield_pct:.12g}")]
                for r in rows}

    def _stored(self) -> dict[str, list] | None:
        path = f"{self.root}/month_context"
        return json.loads(self.spark.read.text(path, wholetext=True).first()[0]) if has_data(self.spark, path) else None

    def _store(self, context: dict[str, list]) -> None:
        frame = self.spark.createDataFrame([(json.dumps(context, sort_keys=True),)], "value string")
        frame.coalesce(1).write.mode("overwrite").text(f"{self.root}/month_context")

    # ---- marts
    def monthly(self, dirty: Iterable[dt.date] | None) -> set[dt.date]:
        """Rebuild the dirty months of the monthly mart (``None``: all) and of
        those whose context changed; returns them."""
        staged = set(partition_months(self.spark, self.staged))
        self.present, stored = self.context(staged), self._stored()
        if dirty is None or stored is None or not has_data(self.spark, self.mart):
            self.monthly_months = staged | set(partition_months(self.spark, self.mart))
        else:
            revised = {m for m in {*self.present, *stored} if self.present.get(m) != stored.get(m)}
            self.monthly_months = set(dirty) | {dt.date.fromisoformat(m) for m in revised}
        self._rebuild(self.mart, self.monthly_months, staged, lambda months: marts.monthly_transactions_by_region(
            enrich.int_transactions_with_rates(
                self.spark.read.parquet(self.staged).filter(F.col("transaction_month").isin(months)).drop("transaction_month"),
                self.reconciled, self.yields, months=self._frame(months, "transaction_month"))))
        return self.monthly_months

    def lag(self) -> set[dt.date]:
        """Rebuild the months of the lag mart that depend on rebuilt ones; returns them."""
        whole = not has_data(self.spark, self.lagged)
        have = set(partition_months(self.spark, self.mart))
        reach = {add_months(m, n) for m in self.monthly_months for n in (0, *self.lags)}
        gone = set(partition_months(self.spark, self.lagged)) - have
        self.lag_months = have if whole else (reach & have) | gone
        self._rebuild(self.lagged, self.lag_months, have, lambda months: marts.rate_lag_analysis(
            self.spark.read.parquet(self.mart).filter(F.col("month").isin(months)), self.reconciled, self.lags,
            months=self._frame(have, "month")))
        self._store(self.present)
        return self.lag_months

    def _rebuild(self, path: str, months: set[dt.date], source: set[dt.date], build) -> None:
        """Replace the given months of the table; those that the source lost go."""
        fill = sorted(months & source)
        if not has_data(self.spark, path):
            write_partitioned(build(fill), path, "month", CLUSTER)
        elif months:
            publish_partitions(self.spark, build(fill), path, "month", CLUSTER, drop=sorted(months))
