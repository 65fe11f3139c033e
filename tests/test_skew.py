"""One customer holding a third of all orders: results stay exact and the
plans pre-aggregate before any shuffle keyed by customer."""

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from tillroll import operators as op
from tillroll.testdata import AS_OF, TestdataTables

SF = "/root/testdata/sf0.01"
HOT = 7


@pytest.fixture(scope="module")
def skewed(spark):
    t = TestdataTables(spark, SF)
    orders = t.orders().withColumn(
        "customer_id", F.when(F.col("order_id") % 3 == 0, F.lit(HOT).cast("bigint")).otherwise(F.col("customer_id"))
    )
    return t, orders


def test_hot_customer_share(skewed):
    _, orders = skewed
    total = orders.count()
    hot = orders.filter(F.col("customer_id") == HOT).count()
    assert hot >= total // 3


def test_churn_under_skew(spark, skewed):
    _, orders = skewed
    days = {}
    for r in orders.select("customer_id", "order_date").collect():
        days.setdefault(r.customer_id, []).append(r.order_date)
    want = {}
    for customer, own in days.items():
        own.sort()
        gaps = [(b - a).days for a, b in zip(own, own[1:])]
        silent = (AS_OF - own[-1]).days
        if gaps and silent * len(gaps) > 2 * sum(gaps):
            want[customer] = (len(own), silent, sum(gaps) / len(gaps))
    ours = op.churn_risk(orders, AS_OF)
    got = {r.customer_id: (r.total_orders, r.days_since_last_purchase, r.avg_order_gap) for r in ours.collect()}
    assert got.keys() == want.keys()
    assert all(got[c][:2] == want[c][:2] and abs(got[c][2] - want[c][2]) < 1e-9 for c in want)
    text = plan_text(ours)
    assert "partial_count" in text and "Window" not in text


def test_sales_outputs_under_skew(spark, skewed):
    """The hot customer's lines count as anyone's: sums by plain Python."""
    t, orders = skewed
    fact = op.sales_fact(orders, t.order_items(), t.products())
    lines = fact.select("customer_id", "order_year", "order_month", "product_id", "sales_amount").collect()
    by_month, by_year, sold = {}, {}, {}
    for r in lines:
        by_year.setdefault(r.order_year, set()).add(r.customer_id)
        if r.customer_id == HOT:
            by_month[r.order_year, r.order_month] = by_month.get((r.order_year, r.order_month), 0) + r.sales_amount
            key = (r.product_id, r.order_year, r.order_month)
            sold[key] = sold.get(key, 0) + r.sales_amount
    trend = op.customer_purchase_trend(fact, ordered=False).filter(F.col("customer_id") == HOT).collect()
    assert {(r.order_year, r.order_month): r.monthly_spent for r in trend} == by_month
    kept = {r.current_year: r.retained_customers for r in op.retention_rate(fact).collect()}
    assert kept == {y: len(ids & by_year.get(y - 1, set())) for y, ids in by_year.items()}
    yoy = op.yoy_comparison(fact, t.products(), ordered=False).filter(F.col("customer_id") == HOT).collect()
    assert {(r.product_id, r.sales_year, r.sales_month): r.monthly_sales for r in yoy} == sold


def test_profile_sort_cuts_between_equal_amounts(spark):
    """Most profiles spent nothing; no sort partition holds them all."""
    from tillroll.plans.registry import QUERIES

    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    previous = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        for name in ("omni_profile_unified", "omni_profile_reference"):
            df = QUERIES[name](spark, "/root/testdata/sf0.1")
            sizes = sorted(r[1] for r in df.groupBy(F.spark_partition_id()).count().collect())
            assert sizes[-1] <= 2 * sizes[len(sizes) // 2], (name, sizes)
    finally:
        for k, v in previous.items():
            spark.conf.set(k, v)


def test_aqe_splits_hot_customer_in_semi_join(spark, skewed):
    """With thresholds scaled down to the test size, AQE's final plan splits
    the hot customer's partition of the clean_orders semi join."""
    t, orders = skewed
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    previous = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = op.clean_orders(orders, op.clean_customer_ids(t.customers()), AS_OF)
        n = len(df.collect())                 # runs this DataFrame's own plan
        final = plan_text(df, "simple")
    finally:
        for k, v in previous.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert n > 0
    assert "isFinalPlan=true" in final
    assert "SortMergeJoin(skew=true)" in final
