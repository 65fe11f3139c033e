"""Sorted results are in order in the files that are written."""

import os

from tillroll.plans import jobs
from tillroll.sources import MappedTables
from tillroll.sources.order_check import out_of_order
from tillroll.testdata import AS_OF, EVENTS_AS_OF, TestdataTables

SF = "/root/testdata/sf0.01"

# The reference's orders (S1 to S3).
SALES_ORDERS = {
    "peak_sales_months": [("monthly_product_sales", False)],
    "top_customers": [("customer_id", True), ("monthly_sales", False)],
    "customer_purchase_trend": [("customer_id", True), ("spending_growth_pct", True)],
    "retention_rate_pct": [("current_year", True)],
    "month_over_month_growth_pct": [("product_id", True), ("order_year", True), ("order_month", True)],
    "yoy_comparison": [("customer_id", True), ("yoy_growth_percent", False)],
}


def test_jobs_write_their_order(spark, tmp_path):
    t = TestdataTables(spark, SF)
    tables = MappedTables({"orders": t.sales_orders(), "order_items": t.order_items(), "products": t.products(),
                           "historical_customer_sales": t.historical_customer_sales()})
    previous = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")   # several files a result
    try:
        jobs.run_sales_trends(spark, tables, f"{tmp_path}/sales")
        jobs.run_churn(spark, t, f"{tmp_path}/churn", AS_OF)
        jobs.run_omni(spark, t, f"{tmp_path}/omni", AS_OF, events_as_of=EVENTS_AS_OF, unified=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", previous)
    for name, keys in SALES_ORDERS.items():
        assert out_of_order(spark, f"{tmp_path}/sales/{name}", keys).isEmpty(), name
    assert out_of_order(spark, f"{tmp_path}/churn", [("days_since_last_purchase", False)]).isEmpty()
    assert out_of_order(spark, f"{tmp_path}/omni", [("total_spent", False)]).isEmpty()
    assert not out_of_order(spark, f"{tmp_path}/churn", [("days_since_last_purchase", True)]).isEmpty()
    # Two partitions change places: only the boundaries tell.
    folder, keys = f"{tmp_path}/sales/month_over_month_growth_pct", SALES_ORDERS["month_over_month_growth_pct"]
    parts = sorted(f for f in os.listdir(folder) if f.startswith("part-"))
    assert len(parts) > 2
    for a, b in ((parts[0], "swap"), (parts[1], parts[0]), ("swap", parts[1])):
        os.replace(f"{folder}/{a}", f"{folder}/{b}")
    for crc in (f for f in os.listdir(folder) if f.endswith(".crc")):
        os.remove(f"{folder}/{crc}")
    assert out_of_order(spark, folder, keys).count() in (1, 2)


def test_nulls_and_rows_within_a_file(spark, tmp_path):
    df = spark.createDataFrame([(None, 1), (1, 2), (2, 1), (2, None), (None, 0)], "a int, b int").coalesce(1)
    df.write.parquet(f"{tmp_path}/x")
    got = {(r.row) for r in out_of_order(spark, f"{tmp_path}/x", [("a", True), ("b", False)]).collect()}
    assert got == {4}
    assert {r.row for r in out_of_order(spark, f"{tmp_path}/x", [("a", True), ("b", True)]).collect()} == {3, 4}
