"""Time customer-keyed operators with and without a hot customer.

The hot-customer variant moves every third order (a third of all orders and
their lines) to one customer id; the hot-product variant moves the lines of
every third order to one product id. Prints one JSON line per variant.

    python tools/skew_bench.py [sf_dir] [repeats]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tillroll import operators as op  # noqa: E402
from tillroll.session import build_session  # noqa: E402
from tillroll.testdata import AS_OF, TestdataTables  # noqa: E402

HOT_CUSTOMER = 7
HOT_PRODUCT = 7


def timed(df, repeats: int) -> float:
    df.write.format("noop").mode("overwrite").save()
    samples = []
    for _ in range(repeats):
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        samples.append(time.perf_counter() - t0)
    return round(statistics.median(samples), 3)


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    repeats = int(argv[2]) if len(argv) > 2 else 3
    spark = build_session("local[8]", shuffle_partitions=16)
    t = TestdataTables(spark, sf_dir)
    plain = t.orders()
    hot = plain.withColumn(
        "customer_id",
        F.when(F.col("order_id") % 3 == 0, F.lit(HOT_CUSTOMER).cast("bigint")).otherwise(F.col("customer_id")),
    )
    for label, orders in (("plain", plain), ("hot_customer_third", hot)):
        fact = op.sales_fact(orders, t.order_items(), t.products())
        result = {
            "churn_risk": timed(op.churn_risk(orders, AS_OF), repeats),
            "clean_orders": timed(op.clean_orders(orders, op.clean_customer_ids(t.customers()), AS_OF), repeats),
            "customer_purchase_trend": timed(op.customer_purchase_trend(fact), repeats),
            "retention_rate": timed(op.retention_rate(fact), repeats),
            "top_customer_products": timed(op.top_customer_products(fact, t.products()), repeats),
            "customer_segments": timed(op.customer_segments(fact), repeats),
        }
        print(json.dumps({"variant": label, "sf_dir": sf_dir, "seconds": result}))
    items = t.order_items()
    hot_items = items.withColumn(
        "product_id",
        F.when(F.col("order_id") % 3 == 0, F.lit(HOT_PRODUCT).cast("bigint")).otherwise(F.col("product_id")),
    )
    for label, lines in (("plain", items), ("hot_product_third", hot_items)):
        fact = op.sales_fact(plain, lines, t.products())
        result = {
            "sales_fact": timed(fact, repeats),
            "product_mom_growth": timed(op.product_mom_growth(fact, t.products()), repeats),
            "top_customer_products": timed(op.top_customer_products(fact, t.products()), repeats),
            "peak_sales_months": timed(op.peak_sales_months(fact), repeats),
        }
        print(json.dumps({"variant": label, "sf_dir": sf_dir, "seconds": result}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
