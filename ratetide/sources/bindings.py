"""Bind the driver's test tables to the pipeline's raw inputs.

The reference's own landed data is not available; these derivations turn the
TPC-H-like tables into raw tables with the same schemas.  Every derived
table grows with the input tables.  The same definitions are written in SQL
for the DuckDB oracle (``oracle_sql.py``); keep both in step.

* ``raw_transactions``  orders + customer + nation + region; every 10th order
  (by key) is reloaded a second time 30 days later at price + 1, and every
  20th order's reload carries status 'C' (exercises latest-wins and
  dedup-before-filter).  A third of customers have a lower-case,
  tab-padded county, a fifth of the others one in no-break and em spaces,
  every 37th customer none.
* ``county_map``        nation name -> region name; MIDDLE EAST nations are
  left unmapped so they fall into the catch-all bucket.
* ``raw_rates``         'view' events: ten ids share a date, dates are five
  days apart, rate = value / 10 (up to ~34, so the 0..20 range filter bites).
* ``raw_rate_events``   'purchase' events: twenty ids share an event id
  (replays), dates as above but a day later for odd tens, new = value / 20.
  Dates and ids grow with the events, dates up to the calendar's end.  The
  other event types only reach the message stream (``catalog``).
* ``raw_yields``        lineitem: ship date, discount * 100, return flag,
  loaded_at = 2002-01-01 + orderkey seconds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey",
                                               "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # nation/region are fixed 25/5-row dimensions: broadcast is size-safe.
    base = (o.join(c, o.o_custkey == c.c_custkey, "left")
             .join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"), "left")
             .join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"), "left")
             .withColumn("_d", F.to_date("o_orderdate")))
    # every tenth order twice, from one scan
    versions = F.when(F.col("o_orderkey") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    v = (base.withColumn("_version", F.explode(versions))
             .withColumn("_d", F.date_add("_d", F.col("_version") * 30)))
    status = F.when(F.col("o_orderstatus") == "P", "D").otherwise("A")
    return v.select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        (F.floor("o_totalprice").cast("bigint") + F.col("_version")).alias("price"),
        F.concat(F.date_format("_d", "yyyy-MM-dd"), F.lit(" 00:00")).alias("transaction_date"),
        F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" ")).alias("postcode"),
        F.expr("substr('DSTFO', cast(left(o_orderpriority, 1) as int), 1)").alias("property_type"),
        F.when(F.col("o_orderkey") % 2 == 0, "Y").otherwise("N").alias("old_new"),
        F.when(F.col("o_custkey") % 2 == 0, "F").otherwise("L").alias("duration"),
        F.col("o_custkey").cast("string").alias("paon"),
        F.lit(None).cast("string").alias("saon"),
        F.col("c_name").alias("street"),
        F.lit(None).cast("string").alias("locality"),
        F.col("n_name").alias("town_city"),
        F.col("r_name").alias("district"),
        F.when(F.col("o_custkey") % 37 == 0, F.lit(None).cast("string"))
         .when(F.col("o_custkey") % 3 == 0,
               F.concat(F.lit(" "), F.lower("n_name"), F.lit("\t")))
         .when(F.col("o_custkey") % 5 == 0,
               F.concat(F.lit("\xa0"), F.col("n_name"), F.lit("\u2003")))
         .otherwise(F.col("n_name")).alias("county"),
        F.when(F.col("o_orderstatus") == "F", "A").otherwise("B").alias("ppd_category"),
        F.when((F.col("_version") == 1) & (F.col("o_orderkey") % 20 == 0), "C")
         .otherwise(status).alias("record_status"),
    )


def county_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey)
             .filter(F.col("r_name") != "MIDDLE EAST")
             .select(F.upper("n_name").alias("key"), F.col("r_name").alias("value")))


#: Days from the first rate date to the end of year 9936: dates fold there.
CALENDAR_DAYS = 2_900_000


def event_day(shift: int = 0):
    """The rate date of an event: ten ids a date, five days apart; ``shift``
    moves every second date, so two series share half of their dates."""
    days = f"((event_id div 10) * 5 + (event_id div 10) % 2 * {shift}) % {CALENDAR_DAYS}"
    return F.date_add(F.lit("1997-01-01").cast("date"), F.expr(f"cast({days} as int)"))


def raw_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "view")
    return e.select(
        event_day().alias("effective_date"),
        (F.col("value") / 10).alias("base_rate"),
        F.lit("events").alias("source"),
        F.col("ts").cast("timestamp").alias("loaded_at"),
    )


def raw_rate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    return e.select(
        F.concat(F.lit("e"), F.expr("event_id div 20").cast("string")).alias("event_id"),
        event_day(1).alias("effective_date"),
        F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("value") / 25).alias("previous_rate"),
        (F.col("value") / 20).alias("new_rate"),
        F.col("ts").cast("timestamp").alias("published_at"),
    )


def raw_yields(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.to_date("l_shipdate").alias("date"),
        (F.col("l_discount") * 100).alias("yield_pct"),
        F.col("l_returnflag").alias("ticker"),
        # 2002-01-01T00:00:00Z + l_orderkey seconds
        F.timestamp_seconds(F.lit(1009843200) + F.col("l_orderkey")).alias("loaded_at"),
    )


RAW_BUILDERS = {
    "transactions": raw_transactions,
    "rates": raw_rates,
    "rate_events": raw_rate_events,
    "yields": raw_yields,
}


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw table, derived lazily: a query scans what it needs of the test
    tables and nothing is written for it."""
    return RAW_BUILDERS[name](spark, sf_dir)


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: build(spark, sf_dir) for name, build in RAW_BUILDERS.items()}
