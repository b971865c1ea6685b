"""Landed CSV read in parallel wherever no record spans lines.

A quoted field may hold a line break, so a reader cannot start in the middle of a
file unless it knows that there is none.  One pass over the lines, which Spark
splits at will, tells: if each line of a file is a whole number of well-formed
fields, then by induction from the first line no record spans lines.  Such files
are read in splits, the others as one task each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import read_transactions_csv

#: Fields without a quote, or quoted ones with doubled quotes inside.  The
#: quantifiers give nothing back, so a long line costs one pass and no stack.
FIELD = r'(?:"[^"\r]*+(?:""[^"\r]*+)*+"|[^",\r]*+)'
WHOLE_RECORD = rf"^{FIELD}(?:,{FIELD})*+\z"


def _whole(line: Column) -> Column:
    """Does the line read the same alone as within its file?  White-space lines
    and carriage returns are treated unlike by the two readers, so they say no."""
    blank = (F.length(line) > 0) & (F.trim(F.translate(line, "\t\f\x0b", "   ")) == "")
    return line.rlike(WHOLE_RECORD) & ~blank


def spanning_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, lines, open_lines) of files with a line that is no whole record: a
    line break in a field, a carriage return, or a stray quote.  Partially
    aggregated: a task ships one row per file it reads."""
    lines = spark.read.option("lineSep", "\n").text(paths if isinstance(paths, str) else list(paths))
    facts = (lines.select(F.col("_metadata.file_path").alias("file"), _whole(F.col("value")).alias("whole"))
             .groupBy("file").agg(F.count(F.lit(1)).alias("lines"), F.count_if(~F.col("whole")).alias("open_lines")))
    return facts.filter("open_lines > 0")


def read_transactions_csv_split(spark: SparkSession, paths: str | Sequence[str], mode: str = "FAILFAST",
                                base_path: str | None = None) -> DataFrame:
    """``read_transactions_csv`` with the same rows, in which only files with a
    record over several lines are one task.

    Costs one more pass over the text.  The driver gets the names of the spanning
    files, a part of the file list it holds anyway; the condition on the file's
    name picks files before any is opened."""
    spanning = [r.file for r in spanning_files(spark, paths).select("file").collect()]
    read = lambda multiline: read_transactions_csv(spark, paths, multiline, mode, base_path)
    if not spanning:
        return read(False)
    inside = F.col("_metadata.file_path").isin(spanning)
    return read(False).filter(~inside).unionByName(read(True).filter(inside))
