"""Change detection over observations that arrive in any order.

A late observation may make a change of its own, alter the ``previous_rate`` of
the change after it, or end it.  Each micro-batch is compared with what is known:
changes that appear or alter are appended to the event table, those that vanish
come once more with ``retracted`` set.  ``current_changes`` gives the changes that
stand; they are those of the batch twin over all observations so far.

Three tables below ``state_path``:

* ``observations``: one row per series and date, partitioned by month, or by
  longer periods where many months are held (``periods``); ``month`` is the first
  one of the period;
* ``ends``: the first and last observation of each series and period, by period;
* ``events``: a folder per ingest and micro-batch.

A period is compared from its own rows; its first row looks at the last one of the
series' period before, which ``ends`` has.  So a batch reads the periods that it
holds, a group is one series in one period, and no Python runs.  Observations
without a series, a date or a rate are none.  Of one date the observation of the
later batch counts, within a batch the greatest rate.

Events are written before the state: a batch that is done again after a loss keeps
the events that it wrote and only renews the state, which may be repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import deterministic_id, fixed6
from ..operators.dedup import dedup_latest
from ..operators.prefilter import semi_join_few
from ..sinks.publish import publish_partitions, recover
from ..sinks.writers import _fs, has_data, materialize
from .events import _ingest_id
from .periods import fitting_width, in_periods, period_start, publish_periods, table_width

OBSERVATIONS = "series string, effective_date date, base_rate double, month date"
ENDS = "series string, first_date date, first_rate double, last_rate double, month date"
EVENTS = ("series string, event_id string, effective_date date, previous_rate double, new_rate double, "
          "retracted boolean, published_at timestamp")


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    recover(spark, path)
    return spark.read.schema(schema).parquet(path) if has_data(spark, path) else spark.createDataFrame([], schema)


def _publish(spark: SparkSession, rows: DataFrame, path: str, width: int) -> None:
    """Replace the periods that ``rows`` holds; a first write fixes their length."""
    if has_data(spark, path):
        publish_partitions(spark, rows, path, "month", ["series"])
    else:
        publish_periods(spark, rows, path, width, "month", ["series"])


def month_ends(observations: DataFrame) -> DataFrame:
    """First and last observation of each series and period (partial aggregates)."""
    return observations.groupBy("series", "month").agg(
        F.min("effective_date").alias("first_date"), F.min_by("base_rate", "effective_date").alias("first_rate"),
        F.max_by("base_rate", "effective_date").alias("last_rate"))


def _changes(observations: DataFrame, ends: DataFrame) -> DataFrame:
    """Changes inside the periods of ``observations`` and at the first row of every
    period in ``ends``."""
    inside = observations.select("series", "effective_date", "base_rate", F.lag("base_rate").over(
        Window.partitionBy("series", "month").orderBy("effective_date")).alias("previous_rate"))
    first = ends.select("series", F.col("first_date").alias("effective_date"), F.col("first_rate").alias("base_rate"),
                        F.lag("last_rate").over(Window.partitionBy("series").orderBy("month")).alias("previous_rate"))
    found = (inside.filter("previous_rate <> base_rate")
             .unionByName(first.filter("previous_rate IS NULL OR previous_rate <> base_rate")))
    return found.select("series", deterministic_id(F.col("series"), F.col("effective_date").cast("string"),
                                                   fixed6("base_rate")).alias("event_id"),
                        "effective_date", "previous_rate", F.col("base_rate").alias("new_rate"))


def changed_events(before: DataFrame, after: DataFrame) -> DataFrame:
    """Events of ``after`` that are new or altered, and those of ``before`` that
    are gone, marked ``retracted``."""
    old = before.select(F.col("event_id").alias("_id"), F.struct(*before.columns).alias("_old"))
    new = after.select("event_id", F.struct(*after.columns).alias("_new"))
    both = old.join(new, F.col("_id") == F.col("event_id"), "full")
    gone = F.col("_new").isNull()
    altered = F.col("_old").isNull() | ~F.col("_old.previous_rate").eqNullSafe(F.col("_new.previous_rate"))
    return both.filter(gone | altered).select(F.coalesce("_new", "_old").alias("_e"), gone.alias("retracted")).select(
        "_e.*", "retracted")


def _lengthen(spark: SparkSession, seen: str, ends_path: str, rows: DataFrame) -> int:
    """The length of the state's periods, in months, once it is to hold ``rows``.
    Where it grows the state is rewritten, the ends after what they come from."""
    for path in (seen, ends_path):
        recover(spark, path)
    width = fitting_width(spark, seen, "month", rows)
    if has_data(spark, seen) and table_width(spark, seen) < width:
        longer = _table(spark, seen, OBSERVATIONS).withColumn("month", period_start("effective_date", width))
        publish_periods(spark, longer, seen, width, "month", ["series"])
    if has_data(spark, ends_path) and table_width(spark, ends_path) < width:
        publish_periods(spark, month_ends(_table(spark, seen, OBSERVATIONS)), ends_path, width, "month", ["series"])
    return width


def apply_batch(spark: SparkSession, batch: DataFrame, state_path: str, folder: str, published_at=None) -> None:
    """One micro-batch: its events into ``events/<folder>``, then the state."""
    root = state_path.rstrip("/")
    seen, ends_path, out = f"{root}/observations", f"{root}/ends", f"{root}/events/{folder}"
    rows = batch.select("series", "effective_date", "base_rate").dropna().groupBy("series", "effective_date").agg(
        F.max("base_rate").alias("base_rate"))
    rows = materialize(rows, "late_rows")
    width = _lengthen(spark, seen, ends_path, rows)
    rows = rows.withColumn("month", period_start("effective_date", width))
    months = [r.month for r in rows.select("month").distinct().collect()]  # MOST_FOLDERS at most
    fs, marker = _fs(spark, f"{out}/_SUCCESS")
    touched = _table(spark, seen, OBSERVATIONS).filter(in_periods(months, "month"))
    known = semi_join_few(touched, rows.select("series"), "series")
    if not fs.exists(marker):
        ends = materialize(semi_join_few(_table(spark, ends_path, ENDS), rows.select("series"), "series"), "late_ends")
        now = materialize(_newer(known, rows), "late_now")
        ends_now = (ends.join(now.select("series", "month").distinct(), ["series", "month"], "left_anti")
                    .unionByName(month_ends(now)))
        stamp = F.current_timestamp() if published_at is None else F.lit(published_at).cast("timestamp")
        changed_events(_changes(known, ends), _changes(now, ends_now)).withColumn("published_at", stamp).write.mode(
            "overwrite").parquet(out)
    if months:
        _publish(spark, _newer(touched, rows), seen, width)
        months_now = _table(spark, seen, OBSERVATIONS).filter(in_periods(months, "month"))
        _publish(spark, month_ends(months_now), ends_path, width)


def _newer(known: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per series and date, that of ``rows`` where both have one."""
    both = known.withColumn("_new", F.lit(0)).unionByName(rows.withColumn("_new", F.lit(1)))
    return dedup_latest(both, ["series", "effective_date"], ["_new"]).drop("_new")


def start_late_detection(observations: DataFrame, state_path: str, checkpoint_root: str, series_col: str = "series",
                         published_at=None, available_now: bool = True, processing_time: str = "10 seconds"):
    """Start the detector over streaming rows ``(series, effective_date,
    base_rate)``.  One detector may write a state at a time."""
    spark = observations.sparkSession
    ingest = _ingest_id(spark, checkpoint_root)
    obs = observations.select(F.col(series_col).alias("series"), "effective_date", "base_rate")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        apply_batch(spark, batch, state_path, f"ingest={ingest}/batch_id={batch_id:010d}", published_at)

    w = obs.writeStream.foreachBatch(write_batch).option("checkpointLocation", f"{checkpoint_root.rstrip('/')}/late")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def current_changes(spark: SparkSession, state_path: str) -> DataFrame:
    """The changes that stand, from the state alone (one pass over it)."""
    root = state_path.rstrip("/")
    return _changes(_table(spark, f"{root}/observations", OBSERVATIONS), _table(spark, f"{root}/ends", ENDS))


def replayed_events(spark: SparkSession, state_path: str) -> DataFrame:
    """The changes that stand, from the event table alone: the last word on each
    event id, in order of publication, batch and retraction.  This is what a
    consumer of the events arrives at."""
    events = spark.read.schema(f"{EVENTS}, ingest string, batch_id string").parquet(f"{state_path.rstrip('/')}/events")
    last = dedup_latest(events, ["event_id"], ["published_at", "batch_id"])
    return last.filter(~F.col("retracted")).select("series", "event_id", "effective_date", "previous_rate", "new_rate")
