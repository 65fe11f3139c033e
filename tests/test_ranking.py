import datetime as dt
from decimal import Decimal

from conftest import AS_OF, plan_text, rows
from tillroll import operators as op

CUST = "customer_id bigint, first_name string, last_name string, email string, country string"
ORD = "order_id bigint, customer_id bigint, order_date date, total_amount decimal(10,2)"


def test_rank_ties_and_pattern(spark):
    day = AS_OF - dt.timedelta(days=365)   # boundary day is inside
    cust = [(i, f"F{i}", f"L{i}", f"u{i}@x.com", "United States") for i in range(1, 14)]
    cust += [(50, "A", None, "a@x.com", "United Kingdom"), (60, "B", "C", "b@x.com", "Canada")]
    # totals 1300, 1200, ... ; customers 10 and 11 tie at rank 10
    amounts = {i: Decimal(1400 - 100 * i) for i in range(1, 14)}
    amounts[11] = amounts[10]
    o = [(i, i, day, amounts[i]) for i in range(1, 14)]
    o += [(100, 50, AS_OF, Decimal("5")), (101, 60, AS_OF, Decimal("9999")),
          (102, 12, AS_OF - dt.timedelta(days=366), Decimal("99999"))]   # outside the window
    out = op.top_customers_by_country(spark.createDataFrame(o, ORD), spark.createDataFrame(cust, CUST), AS_OF)
    got = rows(out, "country", "customer_id", "spending_rank")
    us = [r for r in got if r[0] == "United States"]
    assert [r[1] for r in us] == list(range(1, 12))          # 11 rows: tie at rank 10
    assert {r[2] for r in us if r[1] in (10, 11)} == {10}
    uk = [r for r in got if r[0] == "United Kingdom"]
    assert uk == [("United Kingdom", 50, 1)]
    assert not [r for r in got if r[0] == "Canada"]
    names = dict(rows(out, "customer_id", "full_name"))
    assert names[50] is None and names[1] == "F1 L1"
    assert out.columns == ["country", "customer_id", "full_name", "email", "total_spent",
                           "total_orders", "last_purchase_date", "spending_rank"]


def test_rank_filter_becomes_group_limit(spark):
    o = spark.createDataFrame([(1, 1, AS_OF, Decimal("1"))], ORD)
    c = spark.createDataFrame([(1, "a", "b", "e", "United States")], CUST)
    plan = plan_text(op.top_customers_by_country(o, c, AS_OF))
    assert "WindowGroupLimit" in plan
    assert "StartsWith(country" in plan


def test_dataframe_form_keeps_customer_columns(spark):
    o = spark.createDataFrame([(1, 1, AS_OF, Decimal("5")), (2, 2, AS_OF, Decimal("7"))], ORD)
    c = spark.createDataFrame([(1, "A", "B", "a@x.com", "United States"),
                               (2, "C", "D", "c@x.com", "United States")], CUST)
    out = op.top_customers_by_country(o, c, AS_OF, all_customer_columns=True)
    assert "full_name" not in out.columns
    assert {"first_name", "last_name", "email", "country", "total_spent", "spending_rank"} <= set(out.columns)
    assert rows(out, "customer_id", "spending_rank") == [(1, 2), (2, 1)]
