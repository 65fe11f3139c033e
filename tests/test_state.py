"""Stored sums and counts that follow new rows; the quarantine of the history."""

import datetime as dt
import json
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import plan_text, rows
from tillroll import operators as op
from tillroll.plans import jobs
from tillroll.plans.registry import full_fact
from tillroll.plans.state import ChurnState, MonthlySums, of_months, touched_months
from tillroll.schema import SALES_FACT
from tillroll.sources import MappedTables
from tillroll.testdata import AS_OF, TestdataTables

SF = "/root/testdata/sf0.001"


def line(n, customer, day, product, price):
    at = dt.datetime.fromisoformat(day)
    return (n, customer, at, product, 1, Decimal(price), Decimal(price), at.year, at.month)


def stored(spark, data, path):
    spark.createDataFrame(data, SALES_FACT).write.mode("overwrite").partitionBy("order_year", "order_month").parquet(path)
    return spark.read.parquet(path).select(*SALES_FACT.fieldNames())


def trends(state, products):
    return [rows(op.peak_months_of_sums(state.read("months"))), rows(op.purchase_trend_of_months(state.read("customers")), *TREND),
            rows(op.mom_growth_of_months(state.read("products"), products))]


TREND = ["customer_id", "order_year", "order_month", "orders_per_month", "monthly_spent", "previous_month_spent",
         "spending_growth_pct", "avg_order_value"]


def full(fact, products):
    return [rows(op.peak_sales_months(fact)), rows(op.customer_purchase_trend(fact), *TREND), rows(op.product_mom_growth(fact, products))]


def test_months_follow_new_and_late_lines(spark, tmp_path):
    rnd = random.Random(3)
    data = [line(rnd.randrange(900), rnd.choice([None, *range(9)]), f"{y}-{m:02d}-{rnd.randrange(1, 28):02d}", rnd.randrange(12),
                 f"{rnd.randrange(5000)}.{rnd.randrange(10)}5") for y in (2020, 2021) for m in range(1, 13) for _ in range(rnd.randrange(30))]
    products = spark.createDataFrame([(k, f"p{k}", "c") for k in range(10)], "product_id bigint, name string, category string")
    state, path = MonthlySums(spark, f"{tmp_path}/sums"), f"{tmp_path}/fact"
    fact = stored(spark, data, path)
    state.update(fact)
    assert trends(state, products) == full(fact, products)
    newer = [line(2000 + k, k % 5, "2022-01-09", k % 12, "7.25") for k in range(20)]                       # a new month
    late = [line(3000, 2, "2020-03-31", 4, "1000.00"), line(3001, None, "2020-03-01", 5, "0.00")]           # late lines in an old one
    untouched = {f: os.stat(f).st_mtime_ns for d, _, fs in os.walk(f"{tmp_path}/sums") for f in (os.path.join(d, x) for x in fs)
                 if "order_year=2021" in f}
    for more in (newer, late):
        data = data + more
        fact = stored(spark, data, path)
        state.update(fact, touched_months(spark.createDataFrame(more, SALES_FACT)))
        assert trends(state, products) == full(fact, products)
    gone = [r for r in data if (r[7], r[8]) != (2020, 6)]                                                # a month that is deleted
    fact = stored(spark, gone, path)
    state.update(fact, [(2020, 6), (2021, 13)])
    assert trends(state, products) == full(fact, products)
    assert untouched and all(os.stat(f).st_mtime_ns == t for f, t in untouched.items())
    one = plan_text(op.month_sums(fact.filter(of_months([(2020, 3)]))))
    assert "PartitionFilters" in one and "2020" in one.split("PartitionFilters")[1][:200]


def test_monthly_job_equals_the_full_queries(spark, tmp_path):
    t = TestdataTables(spark, SF)
    lines = full_fact(t)
    first = lines.filter("order_date < '2001-03-01'")
    first.write.partitionBy("order_year", "order_month").parquet(f"{tmp_path}/fact")
    args = (t.products(), f"{tmp_path}/sums", f"{tmp_path}/out")
    jobs.run_monthly_trends(spark, spark.read.parquet(f"{tmp_path}/fact"), *args)
    rest = lines.filter("order_date >= '2001-03-01'")
    rest.write.mode("append").partitionBy("order_year", "order_month").parquet(f"{tmp_path}/fact")
    res = jobs.run_monthly_trends(spark, spark.read.parquet(f"{tmp_path}/fact"), *args, months=touched_months(rest))
    for name, want in (("peak_sales_months", op.peak_sales_months(lines)), ("customer_purchase_trend", op.customer_purchase_trend(lines)),
                       ("month_over_month_growth_pct", op.product_mom_growth(lines, t.products()))):
        got = spark.read.parquet(f"{tmp_path}/out/{name}")
        assert rows(got, *want.columns) == rows(want) and res.rows[name] == got.count()


def test_churn_state_follows_new_orders(spark, tmp_path):
    orders = TestdataTables(spark, SF).orders().select("order_id", "customer_id", "order_date")
    odd = spark.createDataFrame([(1, None, dt.date(2001, 1, 1)), (2, 7, None), (None, 7, dt.date(1999, 1, 1))],
                                "order_id long, customer_id long, order_date date")
    orders = orders.select("order_id", "customer_id", F.col("order_date").cast("date").alias("order_date")).unionByName(odd)
    state = ChurnState(spark, f"{tmp_path}/state", "churn_a")
    so_far = None
    for low, high in (("1990", "1998"), ("1998", "2001"), ("2001", "2002")):
        known = F.coalesce("order_date", F.lit(dt.date(1998, 5, 5)))
        batch = orders.filter((known >= f"{low}-01-01") & (known < f"{high}-01-01"))
        so_far = batch if so_far is None else so_far.unionByName(batch)
        assert state.merge(batch, high)
        assert not state.merge(batch, high) and not state.merge(batch, low)   # a retry
        assert rows(op.churn_of_customers(state.read(), AS_OF)) == rows(op.churn_risk(so_far, AS_OF))
    res = jobs.run_churn_update(spark, orders.limit(0), state, "2002b", f"{tmp_path}/out", AS_OF)
    assert res.rows["churn_risk"] == op.churn_risk(orders, AS_OF).count() > 0


def test_a_merge_that_fails_changes_nothing(spark, tmp_path):
    state = ChurnState(spark, f"{tmp_path}/state", "churn_b")
    batch = spark.createDataFrame([(k, k % 3, dt.date(2001, 1, 1 + k)) for k in range(9)], "order_id long, customer_id long, order_date date")
    state.merge(batch, "1")
    before = rows(state.read())
    with pytest.raises(Exception, match="no such row"):
        state.merge(batch.withColumn("order_date", F.when(F.col("order_id") < 8, F.col("order_date")).otherwise(F.raise_error(F.lit("no such row")))), "2")
    assert rows(state.read()) == before and state.merge(batch, "2")


HISTORY = ", ".join(f"{c} string" for c in SALES_FACT.fieldNames())
GOOD = ("5", "7", "2019-01-02 10:00:00", "10", "1", "2.5", "2.5", "2019", "1")


def malformed():
    out = [GOOD]
    for k, value in enumerate(["x", "7.5.1", "soon", "99999999999999999999", "3000000000", "123456789012.00", "1e40", "20o1", "Jan"]):
        out.append((*GOOD[:k], value, *GOOD[k + 1:]))
    return [*out, (None,) * 9, ("a", "b", *GOOD[2:])]


def test_checked_history_sets_misfits_apart(spark):
    history = spark.createDataFrame(malformed(), HISTORY)
    got = op.checked_history(history).collect()
    assert [r.reason for r in got] == [None, *SALES_FACT.fieldNames(), None, "order_id,customer_id"]
    assert json.loads(got[3].raw)["order_date"] == "soon" and got[0].raw is None
    good = history.limit(1)
    assert rows(op.checked_history(good).drop("reason", "raw")) == rows(op.align_history(good))
    assert op.checked_history(good).drop("reason", "raw").schema.simpleString() == SALES_FACT.simpleString()


def test_a_malformed_line_lands_in_quarantine_and_the_job_goes_on(spark, tmp_path):
    t = TestdataTables(spark, SF)
    names = SALES_FACT.fieldNames()
    good = t.historical_customer_sales().select(*(F.col(c).cast("string").alias(c) for c in names))
    tables = {"orders": t.sales_orders(), "order_items": t.order_items(), "products": t.products()}
    clean = jobs.run_sales_trends(spark, MappedTables(tables | {"historical_customer_sales": good}), f"{tmp_path}/a")
    bad = spark.createDataFrame(malformed()[1:10], HISTORY)
    mixed = jobs.run_sales_trends(spark, MappedTables(tables | {"historical_customer_sales": good.unionByName(bad)}), f"{tmp_path}/b")
    assert clean.rows == mixed.rows
    assert clean.rejected == {"historical_customer_sales": 0} and mixed.rejected == {"historical_customer_sales": 9}
    for name in clean.rows:
        assert rows(spark.read.parquet(f"{tmp_path}/a/{name}")) == rows(spark.read.parquet(f"{tmp_path}/b/{name}"))
    apart = spark.read.parquet(f"{tmp_path}/b/rejected_history").collect()
    assert {r.reason for r in apart} == set(names)


def test_sums_read_a_stored_fact(spark, monkeypatch):
    from tillroll.plans import state_queries

    plans, update = [], MonthlySums.update

    def seen(self, fact, months=None):
        plans.append(plan_text(fact, "simple"))
        update(self, fact, months)

    monkeypatch.setattr(MonthlySums, "update", seen)
    state, t = state_queries._sums(spark, SF)
    assert len(plans) == 2 and not any("Join" in p for p in plans)
    assert trends(state, t.products()) == full(full_fact(t), t.products())
