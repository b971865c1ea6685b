"""Stored sketches: exact while small, within the bound when large, months refreshed alone."""

import datetime as dt

from pyspark.sql import functions as F

from ratetide.operators.sketch import merge_groups, rank_error, sketch_groups, sketch_quantile, sketch_rows
from ratetide.plans.sketches import median_prices, refresh_price_sketches
from test_change_driven import files

KIND = "transaction_month date, region string, broad_region string, property_type string, price bigint"
JAN, FEB = dt.date(2020, 1, 1), dt.date(2020, 2, 1)


def test_small_groups_are_exact_and_nulls_count_nothing(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("a", 2), ("a", None), (None, 7), ("empty", None)], "k string, v bigint")
    got = {r[0]: tuple(r)[1:] for r in sketch_groups(df, ["k"], "v").select("k", sketch_rows(), sketch_quantile()).collect()}
    assert got == {"a": (3, 2), None: (1, 7), "empty": (0, None)}
    assert sketch_groups(df.limit(0), ["k"], "v").count() == 0


def test_merged_sketches_keep_the_bound(spark):
    n = 200_000
    df = spark.range(n).select((F.col("id") % 97).alias("part"), ((F.col("id") * 7919) % n).alias("v"))
    merged = merge_groups(sketch_groups(df, ["part"], "v"), [])
    for rank in (0.01, 0.25, 0.5, 0.75, 0.99):
        rows, value = merged.select(sketch_rows(), sketch_quantile(rank)).first()
        assert rows == n and abs(value / n - rank) <= rank_error()


def test_refresh_replaces_months_and_leaves_others(spark, tmp_dir):
    path = f"{tmp_dir}/sketches"
    rows = [(JAN, "KENT", "SE", "D", 10), (JAN, "KENT", "SE", "D", 30), (FEB, None, "SE", "D", 50), (FEB, "KENT", "SE", None, 70)]
    refresh_price_sketches(spark, path, spark.createDataFrame(rows, KIND))
    before = files(path)
    fresh = spark.createDataFrame([(FEB, "ESSEX", "SE", "D", 20), (FEB, "KENT", "SE", None, 70)], KIND)
    for _ in range(2):  # a rerun changes nothing
        refresh_price_sketches(spark, path, fresh)
        assert files(path)["month=2020-01-01"] == before["month=2020-01-01"]
        got = {tuple(r)[:2]: tuple(r)[2:] for r in median_prices(spark, path, ["broad_region", "property_type"]).collect()}
        assert got == {("SE", "D"): (3, 20), ("SE", None): (1, 70)}
    # nothing but sketches is read
    plan = median_prices(spark, path, ["broad_region"])._jdf.queryExecution().executedPlan().toString()
    assert "price" not in plan.split("ReadSchema")[1].split("\n")[0]
