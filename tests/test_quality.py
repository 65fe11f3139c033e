import datetime as dt
from decimal import Decimal

import pytest

from conftest import AS_OF, rows
from tillroll import operators as op

CUST = ("customer_id bigint, first_name string, last_name string, email string, phone string, "
        "address string, city string, state string, zip_code int, country string")


def cust(spark, data):
    return spark.createDataFrame(data, CUST)


def base(i, email, first="Ann"):
    return (i, first, "Lee", email, "(555) 123-4567", " 1 Main St ", "Town", "ST", 12345, "US")


def test_clean_customers_email_shapes(spark):
    data = [
        base(1, "ann@example.com"),
        base(2, "no-at-sign.example.com"),        # dropped
        base(3, "a@bcd"),                         # passes only the as-run pattern
        base(4, "  ANN@Example.COM  "),           # checked raw, then trimmed and lowered
        base(5, None),                            # NULL e-mail dropped
        base(None, "x@y.z"),                      # NULL id dropped
        base(6, "two@@at.com"),                   # dropped
    ]
    lenient = op.clean_customers(cust(spark, data))
    strict = op.clean_customers(cust(spark, data), strict_email=True)
    assert [r[0] for r in rows(lenient, "customer_id")] == [1, 3, 4]
    assert [r[0] for r in rows(strict, "customer_id")] == [1, 4]
    r4 = lenient.filter("customer_id = 4").first()
    assert r4.email == "ann@example.com" and r4.phone == "5551234567"
    assert r4.address == "1 Main St" and r4.zip_code == "12345"
    assert dict(lenient.dtypes)["zip_code"] == "string"


def test_clean_customers_distinct_rows_not_ids(spark):
    data = [base(1, "a@b.co", "Ann"), base(1, "a@b.co", "  Ann "), base(1, "a@b.co", "Anne")]
    out = op.clean_customers(cust(spark, data))
    assert rows(out, "customer_id", "first_name") == [(1, "Ann"), (1, "Anne")]


ORD = "order_id bigint, customer_id bigint, order_date timestamp_ntz, status string, total_amount double"


def test_clean_orders_filters(spark):
    c = op.clean_customers(cust(spark, [base(1, "a@b.co"), base(2, "bad")]))
    t = dt.datetime
    o = spark.createDataFrame([
        (10, 1, t(2024, 6, 1), "F", 10.456),          # kept, rounded half up to 10.46
        (10, 1, t(2024, 6, 1), "F", 10.456),          # exact duplicate
        (11, 1, t(2024, 6, 30, 10, 0), "O", 5.0),     # later on the as-of day: kept
        (12, 1, t(2024, 7, 1), "O", 5.0),             # future: dropped
        (13, 1, t(2024, 6, 1), "O", 0.0),             # zero amount: dropped
        (14, 2, t(2024, 6, 1), "O", 5.0),             # unclean customer: dropped
        (15, 3, t(2024, 6, 1), "O", 5.0),             # unknown customer: dropped
        (None, 1, t(2024, 6, 1), "O", 5.0),           # no id: dropped
    ], ORD)
    out = op.clean_orders(o, c, AS_OF)
    assert out.columns == ["order_id", "customer_id", "order_date", "status", "total_amount"]
    assert dict(out.dtypes)["total_amount"] == "decimal(10,2)"
    assert rows(out, "order_id", "total_amount") == [(10, Decimal("10.46")), (11, Decimal("5.00"))]


def test_dq_gate(spark):
    ok = spark.createDataFrame([(1,), (2,)], "k bigint")
    assert op.dq_gate(ok, "t", "k") == 2
    assert op.dq_gate(ok, "t") == 2
    with pytest.raises(op.DataQualityError, match="is empty"):
        op.dq_gate(ok.filter("k > 5"), "t", "k")
    with pytest.raises(op.DataQualityError, match="1 rows of t lack k"):
        op.dq_gate(spark.createDataFrame([(1,), (None,)], "k bigint"), "t", "k")
    rep = op.dq_report({"a": (ok, "k"), "b": (ok.filter("k > 5"), None)})
    assert rows(rep) == [("a", 2, 0, True), ("b", 0, 0, False)]


def test_overflowing_amounts_are_kept_apart(spark, tmp_path):
    from tillroll.plans import jobs
    from tillroll.sources import MappedTables

    c = cust(spark, [base(1, "a@b.co")])
    day = dt.datetime(2024, 6, 1)
    o = spark.createDataFrame([(1, 1, day, "F", 5.0), (2, 1, day, "F", 1e12), (3, 1, day, "F", -1e12),
                               (4, 1, day, "F", 99_999_999.99), (5, 1, day, "F", 99_999_999.996)], ORD)
    empty = spark.createDataFrame([], "x int")
    bronze = MappedTables({"customers": c, "orders": o} | {n: empty for n in jobs.PASSTHROUGH_TABLES})
    res = jobs.run_cleaning(spark, bronze, str(tmp_path / "s"), "silver_q", AS_OF, audit=False,
                            gate_keys=None)   # the copied tables here are empty on purpose
    assert res.rows["orders"] == 2 and res.rows["rejected_orders"] == 2
    silver = spark.read.table("silver_q.orders")
    assert rows(silver, "order_id") == [(1,), (4,)] and silver.filter("total_amount IS NULL").isEmpty()
    assert rows(spark.read.parquet(str(tmp_path / "s" / "rejected_orders")), "order_id", "total_amount") == [
        (2, 1e12), (5, 99_999_999.996)]


def test_clean_orders_same_with_ids_only(spark):
    from tillroll.testdata import TestdataTables

    t = TestdataTables(spark, "/root/testdata/sf0.001")
    full = op.clean_orders(t.orders(), op.clean_customers(t.customers()), "2001-08-01")
    ids = op.clean_orders(t.orders(), op.clean_customer_ids(t.customers()), "2001-08-01")
    assert rows(full) == rows(ids)
    assert len(rows(ids)) > 1000
