"""Periods as partitions: bounded folders over any span of dates, the same rows."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from ratetide.streaming.compact import compact_events, read_events
from ratetide.streaming.periods import MOST_FOLDERS, fitting_width, period_start, table_width
from test_compact import best, land, staged


def folders(table):
    return [f for f in os.listdir(table) if "=" in f and not f.startswith("_")]


def events(years, minute, start=1):
    """One event each month of the years."""
    months = [(y, m) for y in years for m in range(1, 13)]
    return [(f"e{start + i}", dt.date(y, m, 9), None, float(minute), dt.datetime(2021, 1, 1, 0, minute))
            for i, (y, m) in enumerate(months)]


@pytest.mark.parametrize("width", [1, 4, 2048])
def test_period_start(spark, width):
    days = [dt.date(1, 1, 1), dt.date(1, 12, 31), dt.date(1999, 12, 31), dt.date(2000, 1, 1), dt.date(9999, 12, 31), None]
    got = spark.createDataFrame([(d,) for d in days], "d date").select("d", period_start("d", width).alias("p")).collect()
    for d, p in got:
        first = d and ((d.year - 1) * 12 + d.month - 1) // width * width
        assert p == (d and dt.date(first // 12 + 1, first % 12 + 1, 1))


def test_a_long_span_has_few_folders(spark, tmp_dir):
    sink, table = f"{tmp_dir}/s", f"{tmp_dir}/t"
    # short, then so long that periods grow, with moved dates and no date, then one change
    batches = [events(range(2000, 2002), 1), events(range(1950, 1985), 2, 20) + [("e3", None, None, 1.0, dt.datetime(2022, 1, 1))],
               [("e100", dt.date(1950, 1, 2), None, 9.0, dt.datetime(2023, 1, 1))]]
    rows, widths = [], []
    for n, part in enumerate(batches):
        land(spark, sink, "a", n, part)
        rows += part
        before = set(glob.glob(f"{table}/*/*.parquet"))
        compact_events(spark, sink, table, keep_newest=False)
        assert staged(spark, sink, table) == best(rows)
        assert len(folders(table)) <= MOST_FOLDERS + 1  # and that of rows without a date
        widths.append(table_width(spark, table))
    assert widths == [1, 8, 8]
    assert len(before - set(glob.glob(f"{table}/*/*.parquet"))) == 2  # the period left and the one entered
    assert read_events(spark, sink, table).count() == len(best(rows))
    wrong = spark.read.parquet(table).filter(~F.col("effective_month").eqNullSafe(period_start("effective_date", 8)))
    assert wrong.count() == 0


def test_a_table_by_month_is_taken_up(spark, tmp_dir):
    """Written before there were periods: no mark, any number of folders."""
    sink, table = f"{tmp_dir}/s", f"{tmp_dir}/t"
    old = events(range(2000, 2007), 1)
    frame = spark.createDataFrame(old, "event_id string, effective_date date, previous_rate double, new_rate double, published_at timestamp")
    frame.withColumn("effective_month", F.trunc("effective_date", "MM")).coalesce(1).write.partitionBy("effective_month").parquet(table)
    land(spark, sink, "a", 0, events([2001], 2, 500))
    compact_events(spark, sink, table, keep_newest=False)
    assert staged(spark, sink, table) == best(old + events([2001], 2, 500))
    assert table_width(spark, table) == 2 and len(folders(table)) == 42


def test_one_far_date_does_not_lengthen_periods(spark, tmp_dir):
    rows = spark.createDataFrame([(dt.date(1, 1, 1),), (dt.date(9999, 1, 1),), (dt.date(2020, 1, 1),)], "effective_date date")
    assert fitting_width(spark, f"{tmp_dir}/none", "month", rows) == 1
