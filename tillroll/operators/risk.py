"""Churn risk and fraud risk."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.dates import days_since, trailing_window


def customer_orders(orders: DataFrame) -> DataFrame:
    """What churn needs of each customer's orders, in a form that merges:
    customer_id, total_orders, last_order_date, first_order_date, dated_orders."""
    return orders.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        F.max("order_date").alias("last_order_date"),
        F.min("order_date").alias("first_order_date"),
        F.count("order_date").alias("dated_orders"),
    )


def merge_customer_orders(state: DataFrame, newer: DataFrame) -> DataFrame:
    """``customer_orders`` of two sets of orders that share none, from those of
    each: one aggregate over a row per customer and set."""
    columns = newer.columns
    return state.select(*columns).unionByName(newer).groupBy("customer_id").agg(
        F.sum("total_orders").alias("total_orders"),
        F.max("last_order_date").alias("last_order_date"),
        F.min("first_order_date").alias("first_order_date"),
        F.sum("dated_orders").alias("dated_orders"),
    )


def churn_of_customers(
    customers: DataFrame,
    as_of: dt.date | str,
    gap_factor: float = 2,
    ordered: bool = True,
) -> DataFrame:
    """``churn_risk`` from ``customer_orders``."""
    gap = F.when(
        F.col("dated_orders") > 1,
        F.datediff("last_order_date", "first_order_date") / (F.col("dated_orders") - 1),
    ).cast("double")
    out = customers.select(
        "customer_id",
        "total_orders",
        "last_order_date",
        days_since("last_order_date", as_of).alias("days_since_last_purchase"),
        gap.alias("avg_order_gap"),
    ).filter(F.col("days_since_last_purchase") > F.col("avg_order_gap") * gap_factor)
    return out.orderBy(F.desc("days_since_last_purchase"), "customer_id") if ordered else out


def churn_risk(
    orders: DataFrame,
    as_of: dt.date | str,
    gap_factor: float = 2,
    ordered: bool = True,
) -> DataFrame:
    """Customers silent for longer than ``gap_factor`` × their average gap
    between consecutive orders.

    Output: customer_id, total_orders, last_order_date,
    days_since_last_purchase, avg_order_gap (double).

    The average of consecutive date differences telescopes:
    sum(d[i] - d[i-1]) = max(d) - min(d) over the n dated orders, so
    avg_order_gap = datediff(max, min) / (n - 1), NULL for n < 2 (a single
    order never qualifies). This is one hash aggregate with map-side partial
    aggregation instead of a per-customer window sort, so a customer holding
    a third of all orders costs no more than any other key.
    """
    return churn_of_customers(customer_orders(orders), as_of, gap_factor, ordered)


def suspicious_logins(
    logins: DataFrame,
    as_of: dt.date | str,
    days: int = 30,
    max_ips: int = 3,
    max_attempts: int = 10,
) -> DataFrame:
    """Customers with more than ``max_ips`` distinct IPs or more than
    ``max_attempts`` logins in the trailing window.

    Output: customer_id, unique_ips, total_attempts. The exact distinct count
    is planned in two steps (by customer and IP, then by customer), so a hot
    customer is spread over its IPs before the second shuffle.
    """
    return (
        logins.filter(trailing_window("login_date", as_of, days))
        .groupBy("customer_id")
        .agg(
            F.count_distinct("ip_address").alias("unique_ips"),
            F.count(F.lit(1)).alias("total_attempts"),
        )
        .filter((F.col("unique_ips") > max_ips) | (F.col("total_attempts") > max_attempts))
    )


def high_risk_orders(
    orders: DataFrame,
    as_of: dt.date | str,
    days: int = 30,
    min_spent: float = 5000,
    max_orders: int = 5,
) -> DataFrame:
    """Customers who spent more than ``min_spent`` or placed more than
    ``max_orders`` orders in the trailing window.

    Output: customer_id, order_count, total_spent.
    """
    return (
        orders.filter(trailing_window("order_date", as_of, days))
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("order_count"),
            F.sum("total_amount").alias("total_spent"),
        )
        .filter((F.col("total_spent") > min_spent) | (F.col("order_count") > max_orders))
    )


def high_risk_customers(
    orders: DataFrame,
    logins: DataFrame,
    as_of: dt.date | str,
    days: int = 30,
    max_ips: int = 3,
    max_attempts: int = 10,
    min_spent: float = 5000,
    max_orders: int = 5,
    logins_as_of: dt.date | str | None = None,
) -> DataFrame:
    """Distinct customer ids flagged by both ``suspicious_logins`` and
    ``high_risk_orders``. ``logins_as_of`` is the logins' date where it differs.

    Both sides are already one row per customer and hash-partitioned by
    customer_id, so the join reuses that partitioning; Catalyst drops the
    redundant DISTINCT.
    """
    s = suspicious_logins(logins, logins_as_of or as_of, days, max_ips, max_attempts).select("customer_id")
    h = high_risk_orders(orders, as_of, days, min_spent, max_orders).select("customer_id")
    return s.join(h, "customer_id").distinct()
