"""Guards on the physical plans: the scale properties the design relies on."""

import os
import re

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")

import __spark_entry__ as E  # noqa: E402


def plan(spark, key):
    df = E.queries()[key](spark, SF)
    df.write.format("noop").mode("overwrite").save()
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


FACT = re.compile(r"ReadSchema: struct<(o_orderkey:[^>]*)>")


def fact_scans(text):
    return [m.group(1) for m in FACT.finditer(text)]


def test_dedup_pre_limits_before_its_exchange(spark):
    text = plan(spark, "stg_transactions")
    assert "row_number(), 1, Partial" in text  # map-side top-1 per key
    assert re.search(r"hashpartitioning\(transaction_id#\d+", text)
    assert len(fact_scans(text)) == 1


def test_fact_scan_is_pruned_and_joined_by_broadcast(spark):
    text = plan(spark, "monthly_transactions_by_region")
    scans = fact_scans(text)
    assert len(scans) == 1
    assert all("o_comment" not in s and "o_clerk" not in s for s in scans)
    assert "BroadcastHashJoin" in text
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text
    assert "partial_percentile_approx" in text  # mergeable median sketch


def test_building_a_query_lands_no_raw_table(spark):
    from ratetide.session import _scratch_root

    root = _scratch_root(spark).removeprefix("file:")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    E.queries()["int_transactions_with_rates"](spark, SF)
    made = {n.rsplit("-", 1)[0] for n in set(os.listdir(root)) - before}
    assert made == {"month_ctx"}


def test_lag_model_does_not_touch_facts(spark):
    text = plan(spark, "rate_lag_analysis")
    assert fact_scans(text) == []  # the monthly mart is read from its table
    assert "BroadcastNestedLoopJoin" not in text


def test_quality_suite_scans_once(spark):
    text = plan(spark, "dq_suite_transactions")
    assert len(fact_scans(text)) == 1
