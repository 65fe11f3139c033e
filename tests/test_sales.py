import datetime as dt
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from conftest import rows, sort_rows
from tillroll import operators as op
from tillroll.schema import SALES_FACT


def fact_row(oid, cid, day, pid, qty, price):
    day = dt.datetime.fromisoformat(day)
    price = Decimal(price)
    return (oid, cid, day, pid, qty, price, qty * price, day.year, day.month)


def fact(spark, data):
    return spark.createDataFrame([fact_row(*r) for r in data], SALES_FACT)


PRODUCTS = "product_id bigint, name string, category string"


def test_sales_fact_and_union_keep_the_time_of_day(spark):
    o = spark.createDataFrame([(1, 7, dt.datetime(2024, 3, 5, 13, 5)), (2, 8, dt.datetime(2024, 3, 31, 23, 59, 59))],
                              "order_id bigint, customer_id bigint, order_date timestamp_ntz")
    i = spark.createDataFrame([(1, 10, 3, Decimal("2.50")), (1, 99, 1, Decimal("1.00")), (2, 10, 1, Decimal("2.50"))],
                              "order_id bigint, product_id bigint, quantity int, unit_price decimal(10,2)")
    p = spark.createDataFrame([(10, "bolt", "HW")], PRODUCTS)
    cur = op.sales_fact(o, i, p)
    assert rows(cur)[0] == (1, 7, dt.datetime(2024, 3, 5, 13, 5), 10, 3, Decimal("2.50"), Decimal("7.50"), 2024, 3)
    assert dict(cur.dtypes)["sales_amount"] == "decimal(21,2)"
    hist = spark.createDataFrame([("5", "7", "2019-01-02 10:00:00", "10", "1", "2.5", "2.5", "2019", "1")],
                                 ",".join(f"{c} string" for c in SALES_FACT.fieldNames()))
    allf = op.sales_fact_all(cur, hist)
    assert allf.schema.simpleString() == SALES_FACT.simpleString()
    assert rows(allf, "order_id", "order_date", "sales_amount") == [
        (1, dt.datetime(2024, 3, 5, 13, 5), Decimal("7.50")), (2, dt.datetime(2024, 3, 31, 23, 59, 59), Decimal("2.50")),
        (5, dt.datetime(2019, 1, 2, 10), Decimal("2.50"))]
    assert rows(op.peak_sales_months(allf)) == [("2019-01", Decimal("2.50")), ("2024-03", Decimal("10.00"))]
    dated = op.sales_fact_all(op.sales_fact(o.withColumn("order_date", o.order_date.cast("date")), i, p), hist)
    assert rows(dated, "order_date")[-1] == (dt.datetime(2024, 3, 31),)


def test_one_scan_fact_equals_the_union(spark):
    from tillroll.plans.registry import current_fact
    from tillroll.testdata import TestdataTables

    t = TestdataTables(spark, "/root/testdata/sf0.001")
    union = op.sales_fact_all(current_fact(t), t.historical_customer_sales())
    assert rows(union) == rows(t.sales_lines())


def test_purchase_trend_lag_skips_gaps(spark):
    f = fact(spark, [
        (1, 1, "2023-01-10", 1, 1, "100"),
        (2, 1, "2023-01-20", 1, 1, "50"),
        (2, 1, "2023-01-20", 2, 1, "30"),       # same order, second line
        (3, 1, "2023-04-01", 1, 1, "0"),        # gap of two months; spent 0
        (4, 1, "2023-05-01", 1, 1, "10"),       # previous spent is 0 -> NULL pct
    ])
    out = op.customer_purchase_trend(f)
    got = rows(out, "order_month", "orders_per_month", "monthly_spent", "previous_month_spent",
               "spending_growth_pct", "avg_order_value")
    assert got == [
        (1, 2, Decimal("180.00"), None, None, Decimal("60.000000")),
        (4, 1, Decimal("0.00"), Decimal("180.00"), Decimal("-100.00"), Decimal("0E-6")),
        (5, 1, Decimal("10.00"), Decimal("0.00"), None, Decimal("10.000000")),
    ]


def test_retention_by_sets_of_customers(spark):
    data, buyers = [], defaultdict(set)
    for c in range(1, 31):
        for y in range(2015, 2024):
            if (c * 5 + y * 7) % 6 > 1:
                who = None if c % 10 == 0 else c
                data += [(c * 100_000 + y * 10 + n, who, f"{y}-{1 + (c + n) % 12:02d}-28", 1, 1, "1") for n in range(2)]
                buyers[y].add(who)
    expected = []
    for y, ids in buyers.items():
        known = ids - {None}
        kept = known & buyers.get(y - 1, set())
        share = (Decimal(100 * len(kept)) / len(known)).quantize(Decimal("0.01"), ROUND_HALF_UP) if known else None
        expected.append((y, len(known), len(kept), share))
    assert rows(op.retention_rate(fact(spark, data))) == sort_rows(expected)
    assert 0 < sum(e[2] for e in expected) < sum(e[1] for e in expected)


def test_mom_and_yoy(spark):
    p = spark.createDataFrame([(1, "bolt", "HW"), (2, "nut", "HW")], PRODUCTS)
    f = fact(spark, [
        (1, 1, "2022-03-01", 1, 2, "10"),
        (2, 1, "2023-03-01", 1, 3, "10"),      # same month next year: +50%
        (3, 1, "2023-05-01", 1, 1, "10"),      # no previous May -> NULL
        (4, 2, "2021-03-01", 2, 1, "5"),
        (5, 2, "2023-03-01", 2, 1, "10"),      # previous *existing* March is 2021: +100%
    ])
    mom = rows(op.product_mom_growth(f, p), "product_id", "order_year", "order_month",
               "previous_month_sales", "month_over_month_growth_pct")
    assert mom == [(1, 2022, 3, None, None), (1, 2023, 3, Decimal("20.00"), Decimal("50.00")),
                   (1, 2023, 5, Decimal("30.00"), Decimal("-66.67")),
                   (2, 2021, 3, None, None), (2, 2023, 3, Decimal("5.00"), Decimal("100.00"))]
    yoy = rows(op.yoy_comparison(f, p), "customer_id", "product_id", "sales_year", "sales_month",
               "prev_year_sales", "yoy_growth_percent")
    assert yoy == [(1, 1, 2022, 3, None, None), (1, 1, 2023, 3, Decimal("20.00"), Decimal("50.00")),
                   (1, 1, 2023, 5, None, None),
                   (2, 2, 2021, 3, None, None), (2, 2, 2023, 3, Decimal("5.00"), Decimal("100.00"))]


def test_top5_tie_break_and_duplicate_products(spark):
    # seven customers; 5 and 6 tie for fifth place -> the smaller id wins
    data = [(i, i, "2023-01-01", 1, 1, str(100 - i)) for i in range(1, 5)]
    data += [(5, 5, "2023-01-01", 1, 1, "50"), (6, 6, "2023-01-01", 1, 1, "50"), (7, 7, "2023-01-01", 1, 1, "1")]
    f = fact(spark, data)
    assert [r[0] for r in rows(op.top_customers(f))] == [1, 2, 3, 4, 5]
    # product 1 has two identical rows: the reference's join doubles the group
    p = spark.createDataFrame([(1, "bolt", "HW"), (1, "bolt", "HW")], PRODUCTS)
    out = op.top_customer_products(f, p).filter("customer_id = 1").collect()
    assert [(r.year_month, r.product_count, r.monthly_sales) for r in out] == [("2023-01", 2, Decimal("198.00"))]


def test_segments_edges(spark):
    data = [(i, 1, "2024-01-01", 1, 1, "100") for i in range(10)]              # 10 lines, 1000: high
    data += [(20 + i, 2, "2024-01-01", 1, 1, "99.99") for i in range(10)]      # 10 lines, 999.90 -> regular
    data += [(40 + i, 3, "2024-01-01", 1, 1, "100") for i in range(4)]          # 4 lines: occasional
    data += [(60 + i, 4, "2024-01-02", 1, 1, "100") for i in range(5)]          # 5 lines, 500: regular
    data += [(80 + i, 5, "2024-01-02", 1, 1, "99.99") for i in range(5)]        # 499.95: occasional
    out = rows(op.customer_segments(fact(spark, data)), "customer_id", "purchase_count", "customer_segment")
    assert out == [(1, 10, "High-Value Customer"), (2, 10, "Regular Customer"), (3, 4, "Occasional Buyer"),
                   (4, 5, "Regular Customer"), (5, 5, "Occasional Buyer")]


def test_peak_months(spark):
    f = fact(spark, [(1, 1, "2023-01-05", 1, 1, "5"), (2, 1, "2023-01-25", 1, 1, "5"), (3, 1, "2023-11-01", 1, 1, "3")])
    assert op.peak_sales_months(f).collect()[0].year_month == "2023-01"
    assert rows(op.peak_sales_months(f)) == [("2023-01", Decimal("10.00")), ("2023-11", Decimal("3.00"))]


def test_top_five_read_the_fact_once(spark):
    from conftest import plan_text
    from tillroll.plans.registry import QUERIES

    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    previous = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        for name in ("top_customer_products", "yoy_comparison"):
            df = QUERIES[name](spark, "/root/testdata/sf0.001")
            assert df.collect()
            final = plan_text(df, "simple").split("== Initial Plan ==")[0]
            ran = [line for line in final.splitlines() if "lineitem.parquet" in line]
            assert len(ran) == 1, (name, final)
    finally:
        for k, v in previous.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_output_order(spark):
    f = fact(spark, [(1, 2, "2023-01-05", 1, 1, "5"), (2, 1, "2023-01-25", 2, 1, "9"), (3, 1, "2023-03-01", 1, 1, "30"),
                     (4, 1, "2022-03-01", 1, 2, "3"), (5, 2, "2022-01-01", 1, 1, "5"), (6, 2, "2022-06-01", 2, 1, "1")])
    p = spark.createDataFrame([(1, "bolt", "HW"), (2, "nut", "HW")], PRODUCTS)

    def got(df, *cols):
        return [tuple(r) for r in df.select(*cols).collect()]

    assert got(op.peak_sales_months(f), "year_month") == [("2023-03",), ("2023-01",), ("2022-03",), ("2022-01",), ("2022-06",)]
    assert got(op.top_customer_products(f, p), "customer_id", "monthly_sales") == [
        (1, Decimal(30)), (1, Decimal(9)), (1, Decimal(6)), (2, Decimal(5)), (2, Decimal(5)), (2, Decimal(1))]
    trend = got(op.customer_purchase_trend(f), "customer_id", "spending_growth_pct")
    assert trend == sorted(trend, key=lambda r: (r[0], r[1] is not None, r[1] or 0))
    assert got(op.retention_rate(f), "current_year") == [(2022,), (2023,)]
    assert got(op.product_mom_growth(f, p), "product_id", "order_year", "order_month") == [
        (1, 2022, 1), (1, 2022, 3), (1, 2023, 1), (1, 2023, 3), (2, 2022, 6), (2, 2023, 1)]
    yoy = got(op.yoy_comparison(f, p), "customer_id", "yoy_growth_percent")
    assert yoy == sorted(yoy, key=lambda r: (r[0], r[1] is None, -(r[1] or 0)))
