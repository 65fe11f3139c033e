"""Physical-plan checks on the parquet test tables: pushdown, pruning,
partial aggregation, bounded broadcasts, no Python in the hot path."""

import pytest

from conftest import plan_text
from tillroll.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan_text(fn(spark, SF)) for name, fn in QUERIES.items()}


def test_no_python_udfs(plans):
    for name, text in plans.items():
        assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text, name


def test_date_bounds_pushed_to_scan(plans):
    # trailing 30-day window as a timestamp range on the orders scan
    assert "GreaterThanOrEqual(o_orderdate,2001-07-02T00:00)" in plans["high_risk_orders"]
    # order_date <= as_of compared as dates: everything before the next midnight
    assert "LessThan(o_orderdate,2001-08-02T00:00)" in plans["clean_orders"]
    # the current/history split of the sales fact reaches both order scans
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01T00:00)" in plans["sales_fact_all"]
    assert "LessThan(o_orderdate,1998-01-01T00:00)" in plans["sales_fact_all"]
    # the events' window on their own clock
    for name, bound in (("suspicious_logins", "2024-01-01"), ("high_risk_customers", "2024-01-01"),
                        ("support_activity", "2023-11-02"), ("omni_profile_unified", "2023-11-02")):
        assert f"GreaterThanOrEqual(ts,{bound}T00:00)" in plans[name], name
    # interactions are filtered in their arrays; nothing is shuffled to flatten them
    assert "Exchange" not in plans["flatten_interactions"] and "filter(" in plans["flatten_interactions"]
    # logins read three event columns only
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,props:string>" in plans["suspicious_logins"]


def test_column_pruning(plans):
    # churn reads three order columns only
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in plans["churn_risk"]


def test_partial_aggregation_before_shuffle(plans):
    for name in ("churn_risk", "customer_spending", "omni_profile_unified", "peak_sales_months"):
        assert "partial_" in plans[name], name


def test_churn_needs_no_window(plans):
    assert "Window" not in plans["churn_risk"]


def test_top5_is_taken_per_partition(plans):
    assert "TakeOrderedAndProject" in plans["top_customer_products"]


def test_unified_profile_single_aggregate(plans):
    text = plans["omni_profile_unified"]
    assert "Union" in text and "SortMergeJoin" not in text and "BroadcastHashJoin" not in text


def test_reference_profile_spreads_rows_without_ad_id(plans):
    # buyers without engagement have no ad-side id; the support join shuffles
    # them by their own id instead of piling them onto the NULL key
    text = plans["omni_profile_reference"]
    assert "hashpartitioning(_spread_id" in text
    assert "hashpartitioning(_ad_id" not in text


def test_no_task_of_the_fact_sorts_its_lines(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    previous = spark.conf.get(key)
    spark.conf.set(key, "-1")   # as on large tables
    try:
        for name in ("sales_fact", "sales_fact_all", "peak_sales_months"):
            text = plan_text(QUERIES[name](spark, SF), "simple")
            assert "ShuffledHashJoin [order_id" in text, name
            assert "SortMergeJoin [order_id" not in text and "Sort [order_id" not in text, name
    finally:
        spark.conf.set(key, previous)
