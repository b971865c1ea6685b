"""Version ledger of the staged transactions: the newest raw version of every
transaction id, deletions included, and how far raw has been read.

The ledger is a folder of generations, ``through=<run_date>``.  Each holds the
versions that became the newest in one load; the newest over all generations
counts.  A generation is valid once it is complete (``_SUCCESS``), which is also
what moves the high-water mark: the greatest ``run_date`` of a valid generation.
Generations are only ever added, after the staged months they belong to are
written, so a load that is lost half-way is done again with the same result.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import month_start, parse_txn_date
from ..operators.dedup import dedup_latest
from ..operators.prefilter import likely_few
from ..sinks.publish import publish_partitions, recover
from ..sinks.writers import _fs, has_data, write_partitioned
from . import staging

RUN_DATE = "run_date"
BEFORE = "_before"      # month in which an id was staged
PENDING = "pending"     # folder of the generation that is being loaded
FEW = 4                 # unread rows are few where the ledger holds this many times more


@dataclass
class VersionLedger:
    """The ledger at ``path`` of raw rows keyed by ``key``."""

    spark: SparkSession
    path: str
    key: str = "transaction_id"

    def generations(self) -> list[tuple[str, str]]:
        """(run_date, folder) of the complete generations, oldest first."""
        fs, root = _fs(self.spark, self.path)
        if not fs.exists(root):
            return []
        found = []
        for s in fs.listStatus(root):
            name = s.getPath().getName()
            done = _fs(self.spark, f"{s.getPath().toString()}/_SUCCESS")[1]
            if name.startswith("through=") and fs.exists(done):
                found.append((unquote(name.removeprefix("through=")), s.getPath().toString()))
        return sorted(found)

    def mark(self) -> str | None:
        """The greatest run_date that has been taken in."""
        done = self.generations()
        return done[-1][0] if done else None

    def versions(self) -> DataFrame | None:
        """The versions of all generations (several of an id where it changed)."""
        folders = [f for _, f in self.generations() if has_data(self.spark, f)]
        return self.spark.read.parquet(*folders) if folders else None

    def unread(self, raw: DataFrame) -> DataFrame:
        """Raw rows of later run dates than the mark (folders are pruned), and
        rows without one, which are judged again in each load."""
        mark = self.mark()
        if mark is None:
            return raw
        day = F.col(RUN_DATE).cast("string")
        return raw.filter(day.isNull() | (day > F.lit(mark)))

    def prepare(self, rows: DataFrame) -> DataFrame:
        """Write the rows of the next generation, once, beside the others; it does
        not count before ``commit``.  Returns them as written."""
        rows.write.mode("overwrite").parquet(f"{self.path}/{PENDING}")
        return self.spark.read.schema(rows.schema).parquet(f"{self.path}/{PENDING}")

    def commit(self, through: str) -> None:
        """Make the prepared rows the generation ``through``: they are moved without
        their mark, which is set when all of them are there."""
        pending, target = f"{self.path}/{PENDING}", f"{self.path}/through={quote(through, safe='')}"
        fs, folder = _fs(self.spark, target)
        fs.delete(_fs(self.spark, f"{pending}/_SUCCESS")[1], False)
        fs.delete(folder, True)
        if not fs.rename(_fs(self.spark, pending)[1], folder):
            raise OSError(f"cannot move {pending} to {target}")
        fs.create(_fs(self.spark, f"{target}/_SUCCESS")[1]).close()


def _extent(raw: DataFrame) -> tuple[int, str | None]:
    """Number of rows and the newest run date."""
    return tuple(raw.agg(F.count(F.lit(1)), F.max(F.col(RUN_DATE).cast("string"))).first())


def _changed(unread: DataFrame, count: int, ledger: VersionLedger) -> DataFrame:
    """The newest unread version of each id where it is newer than the ledger's,
    with the month ``BEFORE`` in which the ledger's is staged (null: it is not).

    Both sides are reduced to one row an id by a shuffle on the id, and joined as
    they lie.  Where the unread rows are few the ledger passes their bitmap first."""
    columns = unread.columns
    order = staging.version_order(columns, ledger.key)
    on = ["_id", "_no_id"]  # null-safe, as plain keys

    def newest(df: DataFrame) -> DataFrame:
        keyed = df.withColumn("_id", F.coalesce(F.col(ledger.key).cast("string"), F.lit(""))).withColumn("_no_id", F.col(ledger.key).isNull())
        return dedup_latest(keyed, on, order, tie_break=[])

    def version() -> Column:
        return F.struct(*[F.col(c) for c in order])

    known = ledger.versions()
    known = unread.limit(0) if known is None else known.select(*columns)
    if count * FEW <= known.count():
        known = likely_few(known, unread.select(ledger.key), ledger.key)
    was = F.when(staging.is_staged(), month_start(parse_txn_date("transaction_date")))
    known = newest(known).select(*on, version().alias("_known"), was.alias(BEFORE))
    joined = newest(unread).join(known, on, "left")
    return joined.filter(F.col("_known").isNull() | (version() > F.col("_known"))).select(*columns, BEFORE)


def load_versions(spark: SparkSession, raw: DataFrame, path: str, county_map=None,
                  incremental: bool = True, note=None) -> list[dt.date] | None:
    """Bring the staged table at ``path`` up to date with the landed rows and
    return the months that were rewritten (``None``: the whole table).

    ``raw`` has a ``run_date`` column and only ever grows by later run dates.  An
    incremental load reads those alone, looks their ids up in the ledger (few of
    them without shuffling it), and rewrites the months in which a staged row came, changed or
    went, whatever their age.  Other months, and the ledger's old generations,
    are not written; of the staged table only the touched months are read.
    ``note`` is called with the months before anything is written, so that
    what hangs on them can be remembered should this load or a later step be lost.
    """
    note = note or (lambda months: None)
    recover(spark, path)
    month, cluster = "transaction_month", ["region", "property_type"]
    ledger = VersionLedger(spark, f"{path}__versions")

    def staged(versions: DataFrame) -> DataFrame:
        rows = staging.stage_versions(versions, county_map)
        return rows.withColumn(month, month_start("transaction_date"))

    if not incremental or not has_data(spark, path) or ledger.mark() is None:
        newest = ledger.prepare(staging.newest_versions(raw))
        note(None)
        write_partitioned(staged(newest), path, month, cluster, split_cols=["transaction_id"])
        for _, old in ledger.generations():  # of another history
            fs, folder = _fs(spark, old)
            fs.delete(folder, True)
        if (through := _extent(raw)[1]) is not None:
            ledger.commit(through)
        return None

    unread = ledger.unread(raw)
    count, through = _extent(unread)
    if not count:
        return []
    changed = ledger.prepare(_changed(unread, count, ledger))
    after = F.when(staging.is_staged(), month_start(parse_txn_date("transaction_date")))
    # months are bounded by the calendar
    months = changed.select(F.explode(F.array(BEFORE, after)).alias(month)).filter(F.col(month).isNotNull())
    touched = sorted(r[0] for r in months.distinct().collect())
    if touched:
        note(touched)
        fresh = staged(changed)
        # all changed ids, not only those staged before: a lost load may have staged them
        ids = changed.select(F.col(ledger.key).alias("_changed"))
        old = spark.read.parquet(path).filter(F.col(month).isin(touched)).select(*fresh.columns)
        kept = old.join(ids, F.col(ledger.key).eqNullSafe(F.col("_changed")), "left_anti")
        publish_partitions(spark, kept.unionByName(fresh), path, month, cluster, ["transaction_id"], drop=touched)
    if through is not None:
        ledger.commit(through)
    return touched
