import os

import pytest

from conftest import rows
from tillroll import operators as op
from tillroll.plans import jobs
from tillroll.plans.registry import QUERIES, present
from tillroll.sources import MappedTables, write_output
from tillroll.testdata import AS_OF, EVENTS_AS_OF, TestdataTables

SF = "/root/testdata/sf0.001"


def test_write_output_counts_rows(spark, tmp_path):
    df = spark.range(17)
    assert write_output(df, str(tmp_path / "out")) == 17
    assert spark.read.parquet(str(tmp_path / "out")).count() == 17


def test_cleaning_stage_publishes_nine_tables(spark, tmp_path):
    t = TestdataTables(spark, SF)
    res = jobs.run_cleaning(spark, t, str(tmp_path / "silver"), "silver_test", AS_OF)
    assert res.status == "SUCCESS" and len(res.rows) == 10
    assert res.rows["rejected_orders"] == 0
    tables = {r.tableName for r in spark.sql("SHOW TABLES IN silver_test").collect()}
    assert tables == {"customers", "orders", *jobs.PASSTHROUGH_TABLES}
    ext = spark.sql("DESCRIBE TABLE EXTENDED silver_test.orders").collect()
    assert any(r.col_name == "Type" and r.data_type == "EXTERNAL" for r in ext)
    assert res.rows["customers"] == spark.read.table("silver_test.customers").count()
    assert res.rows["orders"] == QUERIES["clean_orders"](spark, SF).count()
    audit = spark.read.parquet(str(tmp_path / "silver" / "cleaning" / "audit_log")).collect()
    assert [(a.job_name, a.status, a.record_count) for a in audit] == [
        ("cleaning", "SUCCESS", res.rows["customers"])]


def test_failure_writes_audit_and_reraises(spark, tmp_path):
    broken = MappedTables({})        # no tables at all
    with pytest.raises(KeyError):
        jobs.run_cleaning(spark, broken, str(tmp_path / "s"), "silver_fail", AS_OF)
    audit = spark.read.parquet(str(tmp_path / "s" / "cleaning" / "audit_log")).collect()
    assert [(a.status, a.record_count) for a in audit] == [("FAILURE", 0)]


def test_sales_trends_job_matches_queries(spark, tmp_path):
    t = TestdataTables(spark, SF)
    tables = MappedTables({
        "orders": t.sales_orders(), "order_items": t.order_items(), "products": t.products(),
        "historical_customer_sales": t.historical_customer_sales(),
    })
    res = jobs.run_sales_trends(spark, tables, str(tmp_path / "gold"))
    assert set(res.rows) == {"peak_sales_months", "top_customers", "customer_purchase_trend",
                             "retention_rate_pct", "month_over_month_growth_pct", "yoy_comparison"}
    written = spark.read.parquet(str(tmp_path / "gold" / "retention_rate_pct"))
    assert rows(present(written)) == rows(QUERIES["retention_rate"](spark, SF))
    seg = spark.table("customer_segmented")
    assert rows(present(seg)) == rows(QUERIES["customer_segments"](spark, SF))


def test_csv_to_parquet(spark, tmp_path):
    src = str(tmp_path / "csv")
    TestdataTables(spark, SF).raw("nation").write.option("header", True).csv(src)
    res = jobs.run_csv_to_parquet(spark, src, str(tmp_path / "pq"),
                                  transform=lambda df: df.filter("n_regionkey = '1'"))
    out = spark.read.parquet(str(tmp_path / "pq"))
    assert res.rows["rows"] == out.count() == 5
    assert {t for _, t in out.dtypes} == {"string"}


def test_other_jobs_write(spark, tmp_path):
    t = TestdataTables(spark, SF)
    assert jobs.run_churn(spark, t, str(tmp_path / "churn"), AS_OF).rows["churn_risk"] == 25
    assert jobs.run_fraud(spark, t, str(tmp_path / "fraud"), AS_OF, EVENTS_AS_OF).rows["high_risk_customers"] == 1
    res = jobs.run_top_customers(spark, t, str(tmp_path / "top"), AS_OF, country_like="NATION_1%",
                                 audit_base=str(tmp_path / "top_audit"))
    assert res.rows["top_customers"] == 59
    assert jobs.run_omni(spark, t, str(tmp_path / "omni"), AS_OF, events_as_of=EVENTS_AS_OF).rows["profile"] == QUERIES["omni_profile_reference"](spark, SF).count()
    with jobs.materialized(op.churn_risk(t.orders(), AS_OF), "churn") as stored:
        assert stored.count() == 25
        files = stored.inputFiles()
        assert files and all(os.path.exists(f.removeprefix("file://")) for f in files)
    assert not any(os.path.exists(f.removeprefix("file://")) for f in files)


def test_all_jobs_bronze_to_gold(spark, tmp_path):
    t = TestdataTables(spark, SF)
    # bronze as the reference's jobs see it: 'orders' holds the current
    # period, older lines live in the history table
    bronze = MappedTables({name: t.table(name) for name in [
        "customers", "order_items", "products", "loginhistory", "usage_history",
        "customersupport", "enterprisecampaigns", "historical_customer_sales"]}
        | {"orders": t.sales_orders()})
    res = jobs.run_all_jobs(spark, bronze, str(tmp_path / "lake"), "silver_pipe", AS_OF, country_like="NATION_1%",
                            events_as_of=EVENTS_AS_OF)
    assert all(r.status == "SUCCESS" for r in res.values())
    assert set(res["sales_trends"].rows) >= {"peak_sales_months", "yoy_comparison"}
    # gold sales trends read silver orders = the cleaned current orders
    peak = spark.read.parquet(str(tmp_path / "lake" / "gold" / "sales_trends" / "peak_sales_months"))
    assert peak.count() == 80
    audit = spark.read.parquet(str(tmp_path / "lake" / "gold" / "audit_log")).collect()
    assert [a.job_name for a in audit] == ["top_customers"]


def test_bucketed_silver_joins_without_shuffle(spark, tmp_path):
    from conftest import plan_text

    t = TestdataTables(spark, SF)
    jobs.run_cleaning(spark, t, str(tmp_path / "silver"), "silver_bkt", AS_OF, audit=False, order_buckets=4)
    orders = spark.read.table("silver_bkt.orders")
    items = spark.read.table("silver_bkt.order_items")
    products = spark.read.table("silver_bkt.products")
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # force a sort-merge join
    try:
        text = plan_text(op.sales_fact(orders, items, products))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
    assert "SortMergeJoin" in text
    assert "Exchange hashpartitioning(order_id" not in text
    assert "Bucketed: true" in text
    assert spark.read.table("silver_bkt.orders").count() == QUERIES["clean_orders"](spark, SF).count()
