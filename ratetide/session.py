"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "ratetide",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every job relies on.

    On a cluster ``master`` stays ``None`` and the launcher decides; tests
    pass ``local[N]``.  Shuffle partitions default to Spark's setting unless
    given: size them to the data (about 128-256 MB per partition).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The cluster's ``spark.checkpoint.dir`` wins.  Only a local master may go
    without it (tests): it gets a fresh private folder, which executors on
    other machines could not see.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="ratetide-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint dir for written tables.  It
    belongs to the application: ``release_scratch`` deletes what is left, at
    the latest when the driver's interpreter ends."""
    import uuid

    root = _scratch_root(spark)
    if root not in _SCRATCH:
        _SCRATCH.add(root)
        atexit.register(release_scratch, spark)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


_SCRATCH: set[str] = set()


def _scratch_root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{spark.sparkContext.applicationId}"


def release_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch tables (frames that read them are
    unusable afterwards)."""
    from py4j.protocol import Py4JError

    if spark.sparkContext._jsc is None:  # already stopped
        return
    try:
        root = _scratch_root(spark)
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except (Py4JError, OSError):  # the JVM ended first
        return
    _SCRATCH.discard(root)


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 256 << 20,
                           minimum: int = 8) -> int:
    """Shuffle partitions so each holds about ``target_bytes`` of input
    (e.g. 100 TB -> ~400k).  With AQE on, set this as the initial count and
    let ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` coalesce."""
    return max(minimum, -(-int(input_bytes) // int(target_bytes)))


def input_bytes(spark: SparkSession, paths) -> int:
    """Bytes below the given paths, from the file system's summary."""
    total = 0
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return total
