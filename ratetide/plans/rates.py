"""Rate-series models: reconciliation, month step function, change events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import deterministic_id, fixed6, month_start, rate_direction
from ..functions.fixed_values import RATE_HISTORY
from ..operators.asof import asof_lookup
from ..operators.changes import detect_changes
from ..operators.dedup import dedup_latest


def int_rates_reconciled(stg_rates: DataFrame, stg_events: DataFrame) -> DataFrame:
    """Batch and streamed rates in one series, one row per effective date;
    a streamed rate beats a batch rate for the same date."""
    batch = stg_rates.select("effective_date", "base_rate", F.lit("batch").alias("source_type"))
    stream = stg_events.select("effective_date", F.col("new_rate").alias("base_rate"),
                               F.lit("streaming").alias("source_type"))
    combined = batch.unionByName(stream)
    priority = F.when(F.col("source_type") == "streaming", 1).otherwise(2).asc()
    deduped = dedup_latest(combined, ["effective_date"], [priority], tie_break=["base_rate"])
    return deduped.withColumn("effective_month", month_start("effective_date"))


def rate_history(spark: SparkSession) -> DataFrame:
    """The fixed 69-entry policy-rate history as a rate series."""
    df = spark.createDataFrame(RATE_HISTORY, "effective_date string, base_rate double")
    return (df.select(F.to_date("effective_date").alias("effective_date"), "base_rate")
              .withColumn("effective_month", month_start("effective_date")))


def backfill_rates(spark: SparkSession, path: str, loaded_at: str | None = None,
                   source: str = "history backfill") -> int:
    """Truncate-load the fixed history into the batch rate table at ``path``
    (raw-rates schema).  Replaces the whole table, daily rows included, as a
    backfill does; returns the number of rows written."""
    from ..sinks.writers import overwrite

    ts = F.current_timestamp() if loaded_at is None else F.lit(loaded_at).cast("timestamp")
    rows = rate_history(spark).select("effective_date", "base_rate",
                                      F.lit(source).alias("source"), ts.alias("loaded_at"))
    return overwrite(rows, path)


def rate_for_month(months: DataFrame, month_col: str, rates: DataFrame,
                   how: str = "left") -> DataFrame:
    """Rate in force for each distinct month: the rate of the latest change
    whose month is <= the month; two changes in one month -> the later one.
    ``how='left'``: months before the first change get NULL (step function
    with an open-ended last interval); ``'inner'``: they are absent."""
    return asof_lookup(months, month_col, rates, "effective_month", "base_rate",
                       order=["effective_date"], how=how)


def rate_change_events(reconciled: DataFrame, include_true_bp: bool = False) -> DataFrame:
    """One row per actual rate change, ordered by date.

    ``rate_change_bps`` keeps the reference's value (a difference in
    percentage points, despite the name); ``direction`` is hike/cut.
    ``include_true_bp`` adds ``rate_change_bp_true`` (the difference in basis
    points, rounded to 4 dp)."""
    changes = detect_changes(reconciled, "effective_date", "base_rate", emit_first=False)
    cols = ["effective_date", "effective_month", "base_rate", "previous_rate",
            (F.col("base_rate") - F.col("previous_rate")).alias("rate_change_bps"),
            rate_direction("base_rate", "previous_rate").alias("direction"),
            "source_type"]
    if include_true_bp:
        cols.append(F.round((F.col("base_rate") - F.col("previous_rate")) * 100, 4)
                    .alias("rate_change_bp_true"))
    return changes.select(*cols).orderBy("effective_date")


def latest_change_events(series: DataFrame, series_name: str = "policy",
                         series_col: str | None = None) -> DataFrame:
    """Batch twin of the streaming change detector: the first observation and
    every observation whose rate differs from the previous one, with the
    same deterministic event id the streaming detector assigns.  ``series_col``
    names the series of each row (default: all are ``series_name``)."""
    name = F.col(series_col) if series_col else F.lit(series_name)
    ev = detect_changes(series, "effective_date", "base_rate", emit_first=True,
                        partition_by=[series_col] if series_col else [])
    return ev.select(
        name.alias("series"),
        deterministic_id(name, F.col("effective_date").cast("string"),
                         fixed6("base_rate")).alias("event_id"),
        "effective_date", "previous_rate", F.col("base_rate").alias("new_rate"))


def current_rate(spark: SparkSession, series: DataFrame | None = None) -> DataFrame:
    """The current policy rate: the latest positive observation of a landed
    public series when there is one, else the last entry of the fixed
    history.  One row ``(effective_date, base_rate)``."""
    from ..sources.files import first_nonempty, latest_positive

    hist = rate_history(spark)
    last = hist.orderBy(F.col("effective_date").desc()).limit(1).select(
        "effective_date", "base_rate")
    candidates = ([latest_positive(series)] if series is not None else []) + [last]
    return first_nonempty(candidates)
