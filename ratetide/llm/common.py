"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    Lambdas of higher-order functions re-evaluate outer expressions for each
    element; a bound lambda variable is not."""
    return F.transform(F.array(value), body)[0]


def free_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores appended until no column has that name
    (compared without case, as Spark resolves names)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def quoted(name: str) -> Column:
    """The column of exactly this name (dots and back-ticks included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with its columns named c0, c1, ...: Arrow functions take no names
    with dots."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns))))


def schema_of(df: DataFrame, *more: str) -> str:
    """The columns of ``df`` and ``more`` as a schema string."""
    return ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in df.schema), *more])


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; every other character stays as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: Column, separators: str) -> Column:
    """Non-empty pieces between runs of ``separators`` (a regular expression
    that matches one whole run); null gives an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here and
    nothing is computed twice, also after an executor is lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@functools.cache
def _trim() -> Callable | None:
    """The C library's function that returns freed memory, where it has one."""
    try:
        return getattr(ctypes.CDLL(None), "malloc_trim", None)
    except OSError:
        return None


def give_back() -> None:
    """Returns what this Python worker has freed to the system.  Spark reuses
    workers; Arrow and the C library keep freed memory, so each idle one would
    stay as large as its largest task."""
    pa.default_memory_pool().release_unused()
    if _trim():
        _trim()(0)


def lightly(work: Callable, *args):
    """``work(*args)``, after which the memory it has freed is given back."""
    try:
        return work(*args)
    finally:
        give_back()


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
