"""Table writers: append, overwrite, partitioned, NDJSON, merge-upsert, schema sync."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def append(df: DataFrame, path: str, partition_by: Sequence[str] = (),
           fmt: str = "parquet") -> int:
    """Append (reruns create duplicates that staging removes); returns the
    number of rows written, observed during the write (no second scan)."""
    obs = Observation("rows_written")
    w = df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return int(obs.get["n"])


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = (),
              fmt: str = "parquet") -> int:
    """Truncate-and-load: the whole table is replaced."""
    obs = Observation("rows_written")
    w = df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return int(obs.get["n"])


def write_partitioned(df: DataFrame, path: str, partition_col: str,
                      cluster_cols: Sequence[str] = (), mode: str = "overwrite",
                      split_cols: Sequence[str] = (), num_files: int | None = None,
                      dynamic: bool = False) -> None:
    """Partition the table by ``partition_col``; inside each file rows are
    clustered by ``cluster_cols`` so Parquet min/max statistics prune row
    groups (the analogue of warehouse clustering).

    Rows are range-partitioned on (partition, cluster..., split...) before
    the write: boundaries come from a sample, so a big partition value is
    spread over several writer tasks instead of one, and ``split_cols``
    (e.g. a unique id) split even a single hot cluster key.  Range
    partitioning is a deterministic function of the data, so a recomputed
    task writes the same rows.  ``dynamic`` replaces only the partitions
    present in ``df``.
    """
    keys = [partition_col, *cluster_cols, *split_cols]
    out = (df.repartitionByRange(num_files, *keys) if num_files
           else df.repartitionByRange(*keys))
    out = out.sortWithinPartitions(partition_col, *cluster_cols)
    w = out.write.mode(mode).partitionBy(partition_col)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def write_ndjson(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line (dates ISO, timestamps ISO with offset)."""
    (df.write.mode(mode)
       .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
       .json(path))


def _null_safe_on(left: DataFrame, right: DataFrame, keys: Sequence[str]):
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_k_{k}"]) for k in keys])


def upsert_rows(existing: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """MERGE semantics as a plan: rows of ``existing`` whose key is in
    ``delta`` are replaced, new keys inserted, keys absent from ``delta``
    kept.  Keys compare null-safe (a NULL key part matches NULL, so a rerun
    replaces instead of inserting again).  Columns follow ``delta`` (schema
    sync: new columns are NULL on kept rows, vanished columns dropped)."""
    dk = delta.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    kept = existing.join(dk, _null_safe_on(existing, dk, keys), "left_anti")
    return schema_sync(kept, delta)


def schema_sync(existing: DataFrame, delta: DataFrame) -> DataFrame:
    """Union with the delta's columns and types: missing ones NULL, extra ones dropped."""
    cols = delta.columns
    present = [(F.col(c) if c in existing.columns else F.lit(None))
               .cast(delta.schema[c].dataType).alias(c) for c in cols]
    return existing.select(*present).unionByName(delta)


def _columns(df: DataFrame, partition_col: str) -> dict[str, str | None]:
    """Names and types; a partition column's type is read from folder names."""
    return {f.name: None if f.name == partition_col else f.dataType.simpleString() for f in df.schema}


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as a table in the shared checkpoint folder and read
    it back: lineage is cut (a lost executor re-reads the files) and, unlike
    an unpersisted ``checkpoint()``, the input is computed only once."""
    from ..session import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def has_data(spark: SparkSession, path: str) -> bool:
    """Is there a data file below ``path``?  (An empty write leaves a folder
    with a marker file only, from which no schema can be read.)"""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    files = fs.listFiles(p, True)
    while files.hasNext():
        if files.next().getPath().getName()[:1] not in "_.":
            return True
    return False


def merge_upsert(spark: SparkSession, target_path: str, delta: DataFrame, keys: Sequence[str],
                 partition_col: str = "month", replace_partitions: bool = False,
                 cluster_cols: Sequence[str] = (), since=None) -> None:
    """Upsert ``delta`` into the Parquet table at ``target_path`` partitioned
    by ``partition_col``.

    Only partitions present in ``delta`` are read and rewritten; every other
    partition is untouched.  The merged rows of the touched partitions are
    written once, beside the table, and then moved into it: a driver lost in
    between leaves the old rows or the new ones (``publish``), and a lost
    executor reads files that still stand.  ``replace_partitions`` drops old keys
    of touched partitions instead of keeping them.  ``since`` (a literal lower
    bound of the delta's partitions) adds static partition pruning of the target
    scan.
    """
    from .publish import publish_partitions, publish_table, recover

    recover(spark, target_path)
    if not has_data(spark, target_path):
        write_partitioned(delta, target_path, partition_col, cluster_cols)
        return
    # the delta is used three times below (touched partitions, anti-join
    # keys, union): write it once so its upstream plan runs once
    delta = materialize(delta, "upsert_delta_in")
    if _columns(spark.read.parquet(target_path), partition_col) != _columns(delta, partition_col):
        # columns or types changed: every partition must carry the new schema
        merged = upsert_rows(spark.read.parquet(target_path), delta, keys)
        publish_table(spark, merged, target_path, partition_col, cluster_cols)
        return
    if replace_partitions:
        merged = delta
    else:
        existing = spark.read.parquet(target_path)
        if since is not None:
            existing = existing.filter((F.col(partition_col) >= F.lit(since))
                                       | F.col(partition_col).isNull())
        # null-safe: rows without a partition value are rewritten with theirs
        touched = delta.select(F.col(partition_col).alias("_touched")).distinct()
        old = existing.join(touched, F.col(partition_col).eqNullSafe(F.col("_touched")), "left_semi")
        merged = upsert_rows(old, delta, keys)
    publish_partitions(spark, merged, target_path, partition_col, cluster_cols)
