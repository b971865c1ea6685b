"""Rate-change event stream: parse, validate, quarantine, land.

Messages are JSON objects with ``event_id`` (required), ``effective_date``
(required), ``new_rate`` (required; number or numeric string),
``previous_rate`` (optional) and ``published_at`` (defaults to "now" only
when the key is absent).  Anything else goes to a quarantine sink with a
reason instead of being redelivered forever.

Delivery is at-least-once; the sink is an append-only Parquet table with one
folder per checkpoint and micro-batch (rewritten on replay, so exactly-once per
batch; a new checkpoint never touches folders of an earlier one).  Replays are
removed downstream by ``stg_rate_events`` (latest ``published_at`` wins).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType

EVENT_COLUMNS = ["event_id", "effective_date", "previous_rate", "new_rate", "published_at"]
MESSAGE_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def _field(m: Column, k: str) -> Column:
    return F.element_at(m, F.lit(k))


def parse_messages(df: DataFrame, value_col: str = "value",
                   default_ts: str | None = None) -> DataFrame:
    """Parse JSON text into typed event columns plus ``error`` (NULL = valid).

    Fields are read as a string map first so a numeric string ("4.5") is
    accepted like a number and a missing key can be told from a NULL value.
    Runs unchanged on a batch or a streaming DataFrame.
    """
    m = F.from_json(F.col(value_col), MapType(StringType(), StringType()))
    now = F.current_timestamp() if default_ts is None else F.lit(default_ts).cast("timestamp")
    parsed = df.select(F.col(value_col).alias("value"), m.alias("_m"))
    has = lambda k: F.map_contains_key(F.col("_m"), F.lit(k))
    out = parsed.select(
        "value",
        _field(F.col("_m"), "event_id").alias("event_id"),
        F.try_to_date(_field(F.col("_m"), "effective_date")).alias("effective_date"),
        _field(F.col("_m"), "previous_rate").try_cast("double").alias("previous_rate"),
        _field(F.col("_m"), "new_rate").try_cast("double").alias("new_rate"),
        F.when(has("published_at"),
               F.try_to_timestamp(_field(F.col("_m"), "published_at")))
         .otherwise(now).alias("published_at"),
        F.col("_m"),
    )
    err = (F.when(F.col("_m").isNull(), "malformed")
            .when(F.col("event_id").isNull(), "missing event_id")
            .when(F.col("effective_date").isNull(), "bad effective_date")
            .when(F.col("new_rate").isNull(), "bad new_rate")
            .when(_field(F.col("_m"), "previous_rate").isNotNull()
                  & F.col("previous_rate").isNull(), "bad previous_rate")
            .when(F.col("published_at").isNull(), "bad published_at"))
    return out.withColumn("error", err).drop("_m")


def valid_events(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error").isNull()).select(*EVENT_COLUMNS)


def bad_events(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error").isNotNull()).select("value", "error")


def event_messages(df: DataFrame) -> DataFrame:
    """Serialise event rows to JSON text (NULL fields omitted), e.g. to land
    a replay or feed a test source."""
    return df.select(F.to_json(F.struct(*EVENT_COLUMNS),
                               {"timestampFormat": MESSAGE_TS_FORMAT}).alias("value"))


def read_message_stream(spark: SparkSession, source_dir: str,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """File source: one message per line.  On a cluster the same pipeline
    reads ``spark.readStream.format("kafka")...select(col("value").cast("string"))``."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(source_dir)


def _ingest_id(spark: SparkSession, checkpoint_root: str) -> str:
    """The id of the ingest that owns a checkpoint: kept as an empty file in the
    checkpoint folder, made on the first start."""
    import uuid

    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root.rstrip('/')}/ingest_id")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(folder):
        for status in fs.listStatus(folder):
            return status.getPath().getName()
    made = uuid.uuid4().hex[:16]
    path = spark._jvm.org.apache.hadoop.fs.Path(folder, made)
    fs.create(path).close()
    return made


def start_ingest(spark: SparkSession, source_dir: str | None, sink_path: str,
                 quarantine_path: str, checkpoint_root: str, available_now: bool = True,
                 processing_time: str = "10 seconds", default_ts: str | None = None,
                 source: DataFrame | None = None):
    """Start the ingest query: one read of the source per micro-batch, two
    outputs (valid events, quarantine).

    Each micro-batch is parsed once, persisted, and written to
    ``ingest=<id>/batch_id=N`` below sink and quarantine with overwrite: a
    batch replayed after a failure rewrites its own folders, so the tables
    stay exactly-once.  The id lies in the checkpoint folder; batch numbers of
    a fresh checkpoint start at 0 again, but under a new id.  The checkpoint (in a shared folder) records which
    source files / offsets are done, so a restart resumes where it stopped.
    ``source`` overrides the file source (e.g. ``read_kafka_messages``).
    """
    stream = source if source is not None else read_message_stream(spark, source_dir)
    parsed = parse_messages(stream, default_ts=default_ts)

    ingest = _ingest_id(spark, checkpoint_root)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            valid_events(batch).write.mode("overwrite").parquet(
                f"{sink_path.rstrip('/')}/ingest={ingest}/batch_id={batch_id}")
            bad_events(batch).write.mode("overwrite").parquet(
                f"{quarantine_path.rstrip('/')}/ingest={ingest}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    w = (parsed.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", f"{checkpoint_root.rstrip('/')}/ingest"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(
        processingTime=processing_time)
    return w.start()


def read_kafka_messages(spark: SparkSession, bootstrap_servers: str, topic: str,
                        starting_offsets: str = "earliest",
                        max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Kafka source for the same pipeline (needs the Kafka connector on the
    classpath; not available in the test image).  Returns ``value`` text,
    so ``parse_messages`` applies unchanged.  ``max_offsets_per_trigger``
    bounds a micro-batch (and with it the per-series group the change
    detector sees at once)."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap_servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load().select(F.col("value").cast("string").alias("value"))
