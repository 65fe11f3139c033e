import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tillroll.functions import (
    as_of_date,
    days_since,
    digits_only,
    email_shape,
    full_name,
    pct_change,
    safe_pct,
    trailing_window,
)


def test_email_shape(spark):
    df = spark.createDataFrame([("a@b.co",), ("a@bcd",), ("ab.cd",), ("a@@b.c",), (None,), (" A@B.CO ",)], "e string")
    got = df.select(email_shape("e").alias("r"), email_shape("e", strict=True).alias("s")).collect()
    assert [(r.r, r.s) for r in got] == [(True, True), (True, False), (False, False),
                                          (False, False), (None, None), (True, True)]


def test_text_helpers(spark):
    df = spark.createDataFrame([("(555) 12-3", "Ann", "Lee"), ("x", "Bo", None)], "p string, f string, l string")
    got = df.select(digits_only("p").alias("d"), full_name("f", "l").alias("n")).collect()
    assert [(r.d, r.n) for r in got] == [("555123", "Ann Lee"), ("", None)]


def test_percentages(spark):
    df = spark.createDataFrame(
        [(Decimal("150.00"), Decimal("100.00"), 1, 3), (Decimal("1.00"), Decimal("0.00"), 0, 0),
         (Decimal("2.00"), None, 2, 3)],
        "c decimal(31,2), p decimal(31,2), r bigint, t bigint",
    )
    got = df.select(pct_change("c", "p").alias("g"), safe_pct("r", "t").alias("s")).collect()
    assert [(r.g, r.s) for r in got] == [(Decimal("50.00"), Decimal("33.33")), (None, None),
                                          (None, Decimal("66.67"))]


def test_dates(spark):
    as_of = dt.date(2024, 3, 31)
    df = spark.createDataFrame([(dt.date(2024, 3, 1),), (dt.date(2024, 2, 29),), (dt.date(2024, 5, 1),)], "d date")
    got = df.select(trailing_window("d", as_of, 30).alias("w"), days_since("d", as_of).alias("n")).collect()
    assert [(r.w, r.n) for r in got] == [(True, 30), (False, 31), (True, -31)]
    assert df.select(as_of_date("2024-03-31").alias("a")).first().a == as_of
    ts = spark.createDataFrame([(dt.datetime(2024, 3, 1, 0, 0),), (dt.datetime(2024, 2, 29, 23, 59),)], "t timestamp_ntz")
    assert [r.w for r in ts.select(trailing_window(F.col("t"), as_of, 30).alias("w")).collect()] == [True, False]
