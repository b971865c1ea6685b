"""Publishing rewritten partitions, or a whole table, so that a lost driver leaves
the old table or the new one.

New folders are written beside the table (``<table>.__next``).  Then a record of
what is to be swapped is written (``<table>.__commit``); once it is complete the
publish is decided.  Folders are then moved one by one, and the record and what
is left over go last.  ``recover`` finishes a publish that has a complete record
and drops one that has not; every writer calls it first.  Moves are renames: on
a file system without them a swap takes as long as a copy, and is recovered the
same way.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from .writers import _fs, write_partitioned


def _paths(path: str) -> tuple[str, str, str]:
    path = path.rstrip("/")
    return f"{path}.__next", f"{path}.__commit", f"{path}.__old"


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p) and not fs.delete(p, True):
        raise OSError(f"cannot delete {path}")


def _move(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _fs(spark, source)
    if not fs.rename(p, _fs(spark, target)[1]):
        raise OSError(f"cannot move {source} to {target}")


def _folders(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if "=" in s.getPath().getName()) if fs.exists(p) else []


def _record(spark: SparkSession, path: str, what: dict) -> None:
    frame = spark.createDataFrame([(json.dumps(what),)], "value string")
    frame.coalesce(1).write.mode("overwrite").text(_paths(path)[1])


def _recorded(spark: SparkSession, path: str) -> dict | None:
    commit = _paths(path)[1]
    if not _exists(spark, f"{commit}/_SUCCESS"):
        return None
    return json.loads(spark.read.text(commit, wholetext=True).first()[0])


def publish_partitions(spark: SparkSession, rows: DataFrame, path: str, partition_col: str,
                       cluster_cols: Sequence[str] = (), split_cols: Sequence[str] = (), drop: Iterable = ()) -> None:
    """Replace the partitions of the table at ``path`` that ``rows`` holds and
    delete those of the values in ``drop`` that it does not hold.  ``rows`` may
    read the table: it is written in full before anything is moved."""
    recover(spark, path)
    following = _paths(path)[0]
    write_partitioned(rows, following, partition_col, cluster_cols, split_cols=split_cols)
    full = _folders(spark, following)
    gone = [n for v in drop if (n := f"{partition_col}={v}") not in full]
    _record(spark, path, {"full": full, "gone": gone})
    recover(spark, path)


def publish_table(spark: SparkSession, rows: DataFrame, path: str, partition_col: str,
                  cluster_cols: Sequence[str] = (), split_cols: Sequence[str] = (), marks: Sequence[str] = ()) -> None:
    """Replace the whole table at ``path`` by ``rows``, which may read it.
    ``marks`` names empty files that lie in the new table's folder."""
    recover(spark, path)
    following = _paths(path)[0]
    write_partitioned(rows, following, partition_col, cluster_cols, split_cols=split_cols)
    for name in marks:
        fs, p = _fs(spark, f"{following}/{name}")
        fs.create(p).close()
    _record(spark, path, {"whole": True})
    recover(spark, path)


def recover(spark: SparkSession, path: str) -> None:
    """Finish a decided publish of the table at ``path``, drop an undecided one.
    Each step may be repeated; nothing is done where no publish was lost."""
    path = path.rstrip("/")
    following, commit, old = _paths(path)
    what = _recorded(spark, path)
    if what is None:
        _remove(spark, following)
        _remove(spark, commit)
        return
    if what.get("whole"):
        if _exists(spark, following):
            if _exists(spark, path):
                _remove(spark, old)
                _move(spark, path, old)
            _move(spark, following, path)
    else:
        for name in what["full"]:
            if _exists(spark, f"{following}/{name}"):  # else it was moved before
                _remove(spark, f"{path}/{name}")
                _move(spark, f"{following}/{name}", f"{path}/{name}")
        for name in what["gone"]:
            _remove(spark, f"{path}/{name}")
        _remove(spark, following)
    _remove(spark, old)
    _remove(spark, commit)
