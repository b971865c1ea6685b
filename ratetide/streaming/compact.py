"""Compaction of the streamed event table.

The ingest leaves one folder per micro-batch.  ``compact_events`` merges landed
folders into a table partitioned by the month of ``effective_date`` (by longer
periods where it holds many months, see ``periods``) with one row per event (latest
publish wins, as in staging), notes for each ingest up to which
batch the table holds it, and deletes the folders it took up.  ``read_events``
gives the table and the folders that are not in it yet; staging takes its result
like the raw table.

Every step may be lost and repeated: the table is published as a whole set of
periods (``sinks.publish``), then the note is written, then folders go.  Folders
that are merged twice change nothing, as an event is kept once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import dedup_latest
from ..operators.prefilter import semi_join_few
from ..plans.staging import stg_rate_events
from ..sinks.publish import publish_partitions, recover
from ..sinks.writers import _fs, has_data, materialize
from .periods import fitting_width, in_periods, period_start, publish_periods, table_width

EVENT_SCHEMA = ("event_id string, effective_date date, previous_rate double, new_rate double, "
                "published_at timestamp")
MONTH = "effective_month"
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _values(spark: SparkSession, path: str, name: str) -> list[str]:
    """Values of the folders ``<name>=<value>`` in ``path``."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(n.removeprefix(f"{name}=") for n in names if n.startswith(f"{name}="))


def _complete(spark: SparkSession, folder: str) -> bool:
    fs, p = _fs(spark, f"{folder}/_SUCCESS")
    return fs.exists(p)


def landed_batches(spark: SparkSession, sink_path: str) -> dict[str, list[int]]:
    """Numbers of the micro-batches in the event table, for each ingest.  A
    folder without the marker of a finished write is not listed."""
    root = sink_path.rstrip("/")
    return {i: sorted(int(b) for b in _values(spark, f"{root}/ingest={i}", "batch_id")
                      if _complete(spark, f"{root}/ingest={i}/batch_id={b}"))
            for i in _values(spark, root, "ingest")}


def _notes(table_path: str) -> str:
    return f"{table_path.rstrip('/')}.__held"


def _generations(spark: SparkSession, table_path: str) -> list[int]:
    return sorted(int(g) for g in _values(spark, _notes(table_path), "generation"))


def held_batches(spark: SparkSession, table_path: str) -> dict[str, int]:
    """The last micro-batch of each ingest that the compacted table holds (batches
    are numbered in order, so it holds all before); one entry per checkpoint."""
    for g in reversed(_generations(spark, table_path)):
        folder = f"{_notes(table_path)}/generation={g}"
        if _complete(spark, folder):
            rows = spark.read.schema("ingest string, batch_id long").parquet(folder).collect()
            return {r.ingest: r.batch_id for r in rows}
    return {}


def _note(spark: SparkSession, table_path: str, held: dict[str, int]) -> None:
    """A new generation of the note; older ones go once it is complete."""
    before = _generations(spark, table_path)
    made = max(before, default=0) + 1
    (spark.createDataFrame(sorted(held.items()), "ingest string, batch_id long").coalesce(1)
     .write.parquet(f"{_notes(table_path)}/generation={made}"))
    for g in before:
        fs, p = _fs(spark, f"{_notes(table_path)}/generation={g}")
        fs.delete(p, True)


def _read_batches(spark: SparkSession, sink_path: str, batches: dict[str, list[int]]) -> DataFrame:
    paths = [f"{sink_path.rstrip('/')}/ingest={i}/batch_id={b}" for i, numbers in batches.items() for b in numbers]
    reader = spark.read.schema(EVENT_SCHEMA)
    return reader.parquet(*paths) if paths else spark.createDataFrame([], EVENT_SCHEMA)


def _read_table(spark: SparkSession, table_path: str) -> DataFrame:
    return spark.read.schema(f"{EVENT_SCHEMA}, {MONTH} date").parquet(table_path)


def read_events(spark: SparkSession, sink_path: str, table_path: str) -> DataFrame:
    """All events: the compacted table and the folders that it does not hold.  An
    event may come again in a later folder; staging keeps the latest."""
    recover(spark, table_path)
    held = held_batches(spark, table_path)
    tail = {i: [b for b in numbers if b > held.get(i, -1)] for i, numbers in landed_batches(spark, sink_path).items()}
    rest = _read_batches(spark, sink_path, tail)
    if not has_data(spark, table_path):
        return rest
    return _read_table(spark, table_path).drop(MONTH).unionByName(rest)


def _merge(spark: SparkSession, table_path: str, new: DataFrame) -> None:
    """Publish the periods that ``new`` (one row per event) changes.

    Held versions of its events are found behind a bitmap, without a shuffle of
    the table.  An event whose date moved leaves its old period; periods in which
    every event is newer than what came are not rewritten, unless they become
    longer."""
    held = _read_table(spark, table_path)
    versions = materialize(semi_join_few(held, new.select("event_id"), "event_id"), "compact_versions")
    both = versions.withColumn("_held", F.lit(True)).unionByName(new.withColumn("_held", F.lit(False)))
    latest = dedup_latest(both, ["event_id"], ["published_at"],
                          tie_break=["effective_date", "previous_rate", "new_rate", "_held"])
    changed = materialize(latest.filter(~F.col("_held")).drop("_held"), "compact_changed")
    ids = changed.select("event_id")
    width = fitting_width(spark, table_path, MONTH, changed)
    if width > table_width(spark, table_path):
        rows = held.join(ids, "event_id", "left_anti").unionByName(changed)
        publish_periods(spark, rows.withColumn(MONTH, period_start("effective_date", width)), table_path, width, MONTH,
                        ["effective_date"], ["event_id"])
        return
    left = versions.join(ids, "event_id", "left_semi").select(MONTH)
    periods = [r[0] for r in changed.select(MONTH).union(left).distinct().collect()]
    if not periods:
        return
    kept = held.filter(in_periods(periods, MONTH)).join(ids, "event_id", "left_anti")
    publish_partitions(spark, kept.unionByName(changed), table_path, MONTH, ["effective_date"], ["event_id"],
                       drop=[NULL_FOLDER if p is None else p for p in periods])


def compact_events(spark: SparkSession, sink_path: str, table_path: str, keep_newest: bool = True) -> int:
    """Merge landed micro-batches into the table at ``table_path``; returns how
    many folders were taken up.

    ``keep_newest`` leaves the last batch of each ingest where it is: a restarted
    ingest may write it once more.  Without it no ingest may be running or be
    restarted in the middle of a batch.  Files of the table are bounded by its
    periods and their size, those of the tail by the batches since the last call.
    Rows without an event id or a rate go, as in staging.
    """
    recover(spark, table_path)
    held, landed = held_batches(spark, table_path), landed_batches(spark, sink_path)
    ready = {i: numbers[:-1] if keep_newest else numbers for i, numbers in landed.items()}
    taken = {i: t for i, numbers in ready.items() if (t := [b for b in numbers if b > held.get(i, -1)])}
    if taken:
        new = materialize(stg_rate_events(_read_batches(spark, sink_path, taken)), "compact_new")
        if has_data(spark, table_path):
            width = table_width(spark, table_path)
            _merge(spark, table_path, new.withColumn(MONTH, period_start("effective_date", width)))
        else:
            width = fitting_width(spark, table_path, MONTH, new)
            publish_periods(spark, new.withColumn(MONTH, period_start("effective_date", width)), table_path, width, MONTH,
                            ["effective_date"], ["event_id"])
        held |= {i: numbers[-1] for i, numbers in taken.items()}
        _note(spark, table_path, held)
    for i, numbers in ready.items():  # also what an earlier call that was lost left over
        for b in numbers:
            if b <= held.get(i, -1):
                fs, p = _fs(spark, f"{sink_path.rstrip('/')}/ingest={i}/batch_id={b}")
                fs.delete(p, True)
    return sum(map(len, taken.values()))
