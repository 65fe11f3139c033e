"""Analytics over views that the session already knows, found by name in any
case, with ids and dates as strings."""

import datetime as dt

from pyspark.sql import functions as F

from tillroll import operators as op
from tillroll.sources import SessionTables

NOW = dt.date(2025, 3, 20)


def dates(df, column):
    return df.withColumn(column, F.to_date(column))


def test_risk_from_views_in_any_case(spark):
    recent, old = "2025-03-01", "2025-02-01"
    spark.createDataFrame(
        [("ada", "o-1", recent, 4999.99), ("ada", "o-2", recent, 0.02),       # 5000.01 together
         ("bob", "o-3", recent, 5000.0),                                       # not above the limit
         ("cyd", "o-4", old, 9000.0)],                                         # before the window
        ["customer_id", "order_id", "order_date", "total_amount"],
    ).createOrReplaceTempView("ORDERS")
    logins = [(who, recent, f"10.1.{n}.7") for who in ("ada", "bob", "cyd") for n in range(4)]
    spark.createDataFrame(logins, ["customer_id", "login_date", "ip_address"]).createOrReplaceTempView("loginHISTORY")
    t = SessionTables(spark)
    got = op.high_risk_customers(dates(t.table("orders"), "order_date"), dates(t.table("LoginHistory"), "login_date"), NOW)
    assert [r.customer_id for r in got.collect()] == ["ada"]


def test_churn_from_an_aliased_view(spark):
    spark.createDataFrame(
        [("ada", "o-1", "2024-12-01"), ("ada", "o-2", "2024-12-11"), ("ada", "o-3", "2024-12-21"),   # gap 10, silent 89
         ("bob", "o-4", "2024-11-10"), ("bob", "o-5", "2025-01-04"),                                 # gap 55, silent 75
         ("cyd", "o-6", "2020-01-01")],                                                              # no gap
        ["customer_id", "order_id", "order_date"],
    ).createOrReplaceTempView("shop_orders")
    orders = dates(SessionTables(spark, {"orders": "shop_orders"}).table("orders"), "order_date")
    got = op.churn_risk(orders, NOW).collect()
    assert [(r.customer_id, r.days_since_last_purchase, r.avg_order_gap) for r in got] == [("ada", 89, 10.0)]
