import datetime as dt
from decimal import Decimal

from conftest import AS_OF, d, rows, sort_rows
from tillroll import operators as op

ORDERS = "order_id bigint, customer_id bigint, order_date date, total_amount decimal(10,2)"


def orders(spark, data):
    return spark.createDataFrame(data, ORDERS)


def test_churn_single_order_never_qualifies(spark):
    df = orders(spark, [
        (1, 1, d("2024-01-01"), Decimal("10")),
        (2, 1, d("2024-02-01"), Decimal("10")),
        (3, 1, d("2024-03-01"), Decimal("10")),
        (4, 2, d("2024-01-01"), Decimal("10")),   # single order: NULL gap
        (5, 3, d("2024-06-20"), Decimal("10")),
        (6, 3, d("2024-06-25"), Decimal("10")),   # recent, gap 5, silent 5 days
    ])
    out = op.churn_risk(df, AS_OF)
    assert out.columns == ["customer_id", "total_orders", "last_order_date",
                           "days_since_last_purchase", "avg_order_gap"]
    got = rows(out)
    assert got == [(1, 3, d("2024-03-01"), 121, 30.0)]
    for r in out.collect():
        assert r.days_since_last_purchase > r.avg_order_gap * 2


def churned(data, as_of):
    """By hand: gaps between neighbours in each customer's sorted dates."""
    by = {}
    for order_id, customer, day, _ in data:
        by.setdefault(customer, []).append((order_id, day))
    out = []
    for customer, own in by.items():
        days = sorted(day for _, day in own if day is not None)
        gaps = [(b - a).days for a, b in zip(days, days[1:])]
        if gaps and (as_of - days[-1]).days > 2 * sum(gaps) / len(gaps):
            out.append((customer, len(own), days[-1], (as_of - days[-1]).days, sum(gaps) / len(gaps)))
    return out


def test_churn_by_gaps_of_sorted_dates(spark):
    """Ties, missing dates and missing customers included."""
    data = []
    for n in range(260):
        customer = n * n % 37
        day = None if n % 17 == 5 else d("2022-03-01") + dt.timedelta(days=n * n * 31 % 500)
        data.append((n, None if customer == 9 else customer, day, Decimal("2.50")))
    got = rows(op.churn_risk(orders(spark, data), AS_OF))
    want = sort_rows(churned(data, AS_OF))
    assert [r[:4] for r in got] == [r[:4] for r in want] and len(got) > 5
    assert all(abs(a[4] - b[4]) < 1e-9 for a, b in zip(got, want))


def test_churn_order(spark):
    data = [(n, n // 2, d("2024-01-01") + dt.timedelta(days=n % 2), Decimal("1")) for n in range(20)]
    data += [(90, 77, d("2023-01-01"), Decimal("1")), (91, 77, d("2023-01-03"), Decimal("1"))]
    got = [(r.days_since_last_purchase, r.customer_id) for r in op.churn_risk(orders(spark, data), AS_OF).collect()]
    assert got == sorted(got, key=lambda r: (-r[0], r[1])) and got[0][1] == 77


def logins(spark, data):
    return spark.createDataFrame(data, "customer_id bigint, login_date date, ip_address string")


def test_suspicious_login_threshold_edges(spark):
    day = AS_OF - dt.timedelta(days=30)          # first day of the window: inclusive
    before = AS_OF - dt.timedelta(days=31)       # outside
    data = []
    data += [(1, day, f"1.1.1.{i}") for i in range(3)]           # 3 IPs: not > 3
    data += [(2, day, f"2.2.2.{i}") for i in range(4)]           # 4 IPs: flagged
    data += [(3, day, "3.3.3.3")] * 10                           # 10 attempts: not > 10
    data += [(4, day, "4.4.4.4")] * 11                           # 11 attempts: flagged
    data += [(5, before, f"5.5.5.{i}") for i in range(9)]        # outside the window
    data += [(5, AS_OF + dt.timedelta(days=3), "5.5.5.5")]       # future rows count (no upper bound)
    out = op.suspicious_logins(logins(spark, data), AS_OF)
    assert rows(out) == [(2, 4, 4), (4, 1, 11)]


def test_high_risk_order_edges(spark):
    day = AS_OF - dt.timedelta(days=10)
    data = [
        (1, 1, day, Decimal("5000.00")),                         # not > 5000
        (2, 2, day, Decimal("5000.01")),                         # flagged by spend
    ] + [(10 + i, 3, day, Decimal("1")) for i in range(5)] \
      + [(20 + i, 4, day, Decimal("1")) for i in range(6)]       # 6 orders: flagged
    out = op.high_risk_orders(orders(spark, data), AS_OF)
    assert rows(out, "customer_id", "order_count") == [(2, 1), (4, 6)]


def test_high_risk_customers_needs_both(spark):
    """Every pair of (orders over a limit or not) and (logins over one or not),
    each by either limit; the logins may have a date of their own."""
    day, seen = AS_OF - dt.timedelta(days=3), AS_OF + dt.timedelta(days=400)
    o = [(n, 10, day, Decimal("900")) for n in range(6)]                        # many orders
    o += [(20, 11, day, Decimal("8000")), (21, 12, day, Decimal("8000")), (22, 13, day, Decimal("8000"))]
    o += [(23, 14, day, Decimal("12"))]
    lg = [(10, seen, f"172.16.0.{n}") for n in range(5)] + [(11, seen, "172.16.1.1")] * 12
    lg += [(12, seen, "172.16.2.2")] * 2 + [(14, seen, f"172.16.4.{n}") for n in range(8)]
    lg += [(None, seen, f"172.16.9.{n}") for n in range(8)]
    out = op.high_risk_customers(orders(spark, o), logins(spark, lg), AS_OF, logins_as_of=seen)
    assert out.columns == ["customer_id"]
    assert rows(out) == [(10,), (11,)]
    late = seen + dt.timedelta(days=31)
    assert rows(op.high_risk_customers(orders(spark, o), logins(spark, lg), AS_OF, logins_as_of=late)) == []
