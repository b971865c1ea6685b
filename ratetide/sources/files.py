"""Readers for landed files (explicit schemas, no inference)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

TRANSACTION_COLUMNS = [
    "transaction_id", "price", "transaction_date", "postcode", "property_type", "old_new",
    "duration", "paon", "saon", "street", "locality", "town_city", "district", "county",
    "ppd_category", "record_status",
]
TRANSACTION_SCHEMA = StructType([
    StructField(c, LongType() if c == "price" else StringType(), True)
    for c in TRANSACTION_COLUMNS])
RATES_SCHEMA = "effective_date date, base_rate double, source string, loaded_at timestamp"
YIELDS_SCHEMA = "date date, yield_pct double, ticker string, loaded_at timestamp"
JSON_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

CSV_OPTIONS = {"header": "false", "sep": ",", "quote": '"', "escape": '"',
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
               "nullValue": ""}


def read_transactions_csv(spark: SparkSession, paths: str | Sequence[str],
                          multiline: bool = True, mode: str = "FAILFAST",
                          base_path: str | None = None) -> DataFrame:
    """Headerless 16-column transaction files.  Quoted fields may hold commas,
    doubled quotes and newlines; an empty field is NULL.

    ``multiline`` makes each file one task (a record may span lines); land
    many files, or pass ``multiline=False`` once a scan has shown no
    embedded newlines, to let Spark split large files.  Hive-style folders
    (``year=/run_date=``) become columns.
    """
    r = spark.read.schema(TRANSACTION_SCHEMA).options(**CSV_OPTIONS)
    r = r.option("multiLine", multiline).option("mode", mode)
    if base_path:
        r = r.option("basePath", base_path)
    return r.csv(paths if isinstance(paths, str) else list(paths))


def write_transactions_csv(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                           mode: str = "overwrite") -> None:
    w = df.write.mode(mode).options(**CSV_OPTIONS).option("quoteAll", "false")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def read_rates_json(spark: SparkSession, paths, mode: str = "FAILFAST") -> DataFrame:
    """Daily rate files, one JSON object per line."""
    return (spark.read.schema(RATES_SCHEMA).option("mode", mode)
            .option("timestampFormat", JSON_TS_FORMAT).json(paths))


def read_yields_json(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """Yield files land under ``.../date=<run date>/`` while holding a data
    column ``date``; partition discovery would overwrite the data value, so
    the folder is read recursively without partition inference."""
    return (spark.read.schema(YIELDS_SCHEMA).option("mode", mode)
            .option("timestampFormat", JSON_TS_FORMAT)
            .option("recursiveFileLookup", "true").json(path))


def read_year_range(spark: SparkSession, root: str, start: int, end: int,
                    reader=read_transactions_csv) -> DataFrame:
    """Inclusive ``start..end`` years landed under ``root/year=Y``: one job
    over the list of folders (a missing year fails the read, as a failed
    yearly load stops the backfill)."""
    paths = [f"{root.rstrip('/')}/year={y}" for y in range(int(start), int(end) + 1)]
    return reader(spark, paths, base_path=root)


# ---------------------------------------------------------------- public series files
def read_series_lines(spark: SparkSession, paths) -> DataFrame:
    """Two-column series text (``date,value``): blank lines and the
    ``observation...`` header skipped.  Lines without exactly two fields keep
    their place but have no value, so a tail counts them; ``value`` stays
    text (parse with ``numeric_value``)."""
    lines = spark.read.text(paths)
    return series_from_lines(lines)


def series_from_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    t = F.trim(F.col(col))
    parts = F.split(t, ",")
    kept = lines.filter((t != "") & ~t.startswith("observation"))
    return kept.select(F.trim(parts[0]).alias("observation_date"),
                       F.when(F.size(parts) == 2, F.trim(F.get(parts, F.lit(1)))).alias("value"))


def numeric_value(c: str = "value"):
    """The text as a number; NULL for other text and for NaN (which Spark
    would rank above every number)."""
    v = F.col(c).try_cast("double")
    return F.when(~F.isnan(v), v)


def latest_positive(series: DataFrame, date_col: str = "observation_date",
                    value_col: str = "value") -> DataFrame:
    """The latest observation with a numeric value > 0 as
    ``(effective_date, base_rate)`` (one global aggregate: partial per task)."""
    v = numeric_value(value_col)
    pos = series.select(F.col(date_col).alias("d"), v.alias("v")).filter(F.col("v") > 0)
    best = pos.agg(F.max(F.struct("d", "v")).alias("b"))
    return best.filter(F.col("b").isNotNull()).select(
        F.to_date("b.d").alias("effective_date"), F.col("b.v").alias("base_rate"))


def series_tail(series: DataFrame, n: int, ticker: str, loaded_at=None,
                date_col: str = "observation_date", value_col: str = "value") -> DataFrame:
    """The last ``n`` observations first (top-n by date: each task keeps n,
    the driver merges), *then* non-numeric ones dropped; 4-dp values."""
    tail = series.orderBy(F.col(date_col).desc(), F.col(value_col).desc()).limit(int(n))
    ts = F.current_timestamp() if loaded_at is None else F.lit(loaded_at).cast("timestamp")
    return (tail.select(F.try_to_date(date_col).alias("date"),
                        F.round(numeric_value(value_col), 4).alias("yield_pct"))
                .filter(F.col("yield_pct").isNotNull())
                .select("date", "yield_pct", F.lit(ticker).alias("ticker"),
                        ts.alias("loaded_at")))


def normalise_market_data(df: DataFrame, date_col: str, close_col: str, ticker: str,
                          loaded_at=None) -> DataFrame:
    """Fallback market-data table -> yield rows: rows without a close
    dropped, close rounded to 4 dp, ticker and load time attached."""
    ts = F.current_timestamp() if loaded_at is None else F.lit(loaded_at).cast("timestamp")
    return (df.filter(F.col(close_col).isNotNull())
              .select(F.to_date(date_col).alias("date"),
                      F.round(F.col(close_col), 4).alias("yield_pct"),
                      F.lit(ticker).alias("ticker"), ts.alias("loaded_at")))


def first_nonempty(sources: Sequence[DataFrame]) -> DataFrame:
    """The first source with at least one row; all empty -> error.  ``isEmpty``
    stops at the first row; a source without rows is read to its end."""
    for df in sources:
        if not df.isEmpty():
            return df
    raise ValueError("every source is empty")
