"""Sales trends over the line-level sales fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.columns import pct_change, safe_pct
from tillroll.operators.generic import previous_value, top_k

FACT_COLUMNS = [
    "order_id", "customer_id", "order_date", "product_id",
    "quantity", "unit_price", "sales_amount", "order_year", "order_month",
]

# Customer segment labels and limits (lines, spend).
SEGMENT_HIGH = "High-Value Customer"
SEGMENT_REGULAR = "Regular Customer"
SEGMENT_OCCASIONAL = "Occasional Buyer"
HIGH_MIN_LINES, HIGH_MIN_SPENT = 10, 1000
REGULAR_MIN_LINES, REGULAR_MIN_SPENT = 5, 500


def sales_fact(orders: DataFrame, order_items: DataFrame, products: DataFrame) -> DataFrame:
    """orders ⋈ order_items ⋈ products on named keys, one row per line.

    Output: order_id, customer_id, order_date, product_id, quantity,
    unit_price, sales_amount (= quantity * unit_price, decimal(21,2)),
    order_year, order_month. Only the product key is read from products (the
    join keeps lines of known products, once per matching product row).
    Orders are hashed, lines stream past them (``lines_of_orders``); the
    product join's strategy is left to Catalyst/AQE by measured size.
    """
    o = orders.select("order_id", "customer_id", "order_date")
    i = order_items.select("order_id", "product_id", "quantity", "unit_price")
    p = products.select("product_id")
    return (
        lines_of_orders(o, i)
        .join(p, "product_id")
        .select(
            "order_id", "customer_id", "order_date", "product_id", "quantity", "unit_price",
            (F.col("quantity") * F.col("unit_price")).alias("sales_amount"),
            F.year("order_date").alias("order_year"),
            F.month("order_date").alias("order_month"),
        )
    )


def lines_of_orders(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """orders ⋈ order_items on order_id. A task holds the orders of its
    partition, the smaller and narrower side; a sort-merge join would hold all
    its lines, sorted, beside them."""
    return orders.hint("shuffle_hash").join(order_items, "order_id")


def align_history(history: DataFrame) -> DataFrame:
    """Cast the history table to the fact's column types (nine casts).

    Ids stay 64-bit (the reference narrows them to int, which overflows once
    keys pass 2**31), the order date keeps its time of day, money its decimals.
    """
    return history.select(
        F.col("order_id").cast("bigint").alias("order_id"),
        F.col("customer_id").cast("bigint").alias("customer_id"),
        F.col("order_date").cast("timestamp_ntz").alias("order_date"),
        F.col("product_id").cast("bigint").alias("product_id"),
        F.col("quantity").cast("int").alias("quantity"),
        F.col("unit_price").cast("decimal(10,2)").alias("unit_price"),
        F.col("sales_amount").cast("decimal(21,2)").alias("sales_amount"),
        F.col("order_year").cast("int").alias("order_year"),
        F.col("order_month").cast("int").alias("order_month"),
    )


_HISTORY_TYPES = {
    "order_id": "bigint", "customer_id": "bigint", "order_date": "timestamp_ntz", "product_id": "bigint", "quantity": "int",
    "unit_price": "decimal(10,2)", "sales_amount": "decimal(21,2)", "order_year": "int", "order_month": "int",
}


def checked_history(history: DataFrame) -> DataFrame:
    """``align_history`` that stops at no row: the fact's columns, ``reason``
    (the columns whose value does not fit their type, null for none) and
    ``raw`` (the row as it came, as JSON, where there is a reason)."""
    cast = {c: F.col(c).try_cast(t) for c, t in _HISTORY_TYPES.items()}
    bad = F.array_compact(F.array(*(F.when(F.col(c).isNotNull() & x.isNull(), F.lit(c)) for c, x in cast.items())))
    reason = F.when(F.size(bad) > 0, F.array_join(bad, ","))
    return history.select(
        *(x.alias(c) for c, x in cast.items()), reason.alias("reason"),
        F.when(reason.isNotNull(), F.to_json(F.struct(*history.columns))).alias("raw"))


def checked_fact_all(current: DataFrame, history: DataFrame) -> DataFrame:
    """``sales_fact_all`` with ``rejected``, ``reason`` and ``raw``: lines of the
    history whose values do not fit are rejected and go on beside the fact, so
    that one pass over both tables gives the fact and the quarantine."""
    none = F.lit(None).cast("string")
    good = _typed(current).select("*", none.alias("reason"), none.alias("raw"))
    return good.unionByName(checked_history(history)).withColumn("rejected", F.col("reason").isNotNull())


def _typed(current: DataFrame) -> DataFrame:
    return current.select(
        F.col("order_id").cast("bigint").alias("order_id"),
        F.col("customer_id").cast("bigint").alias("customer_id"),
        F.col("order_date").cast("timestamp_ntz").alias("order_date"),
        *[F.col(c) for c in FACT_COLUMNS[3:]],
    )


def sales_fact_all(current: DataFrame, history: DataFrame) -> DataFrame:
    """Current lines ∪ aligned history, matched by column name. Order dates
    are timestamps: a date is its midnight."""
    return _typed(current).unionByName(align_history(history))


def _sum_type(df: DataFrame, col: str) -> T.DataType:
    """Result type of ``sum(col)``, to keep a two-step sum typed as one."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.DecimalType):
        return T.DecimalType(min(38, dtype.precision + 10), dtype.scale)
    return dtype


def _month_start() -> Column:
    # Grouping by the first day of the month is the same partition of rows as
    # grouping by 'yyyy-MM', but avoids formatting a string on every line;
    # the label is formatted once per group afterwards.
    return F.trunc("order_date", "MM").alias("_month")


def _year_month() -> Column:
    return F.date_format("_month", "yyyy-MM").alias("year_month")


def peak_sales_months(fact: DataFrame, ordered: bool = True) -> DataFrame:
    """Output: year_month ('yyyy-MM'), monthly_product_sales; largest first."""
    out = fact.groupBy(_month_start()).agg(F.sum("sales_amount").alias("monthly_product_sales")).select(
        _year_month(), "monthly_product_sales"
    )
    return out.orderBy(F.desc("monthly_product_sales"), "year_month") if ordered else out


def month_sums(fact: DataFrame) -> DataFrame:
    """order_year, order_month, month, monthly_product_sales: one row a month
    (more only where a line's year and month are not those of its date)."""
    return fact.groupBy("order_year", "order_month", F.trunc("order_date", "MM").alias("month")).agg(
        F.sum("sales_amount").alias("monthly_product_sales"))


def peak_months_of_sums(sums: DataFrame, ordered: bool = True) -> DataFrame:
    """``peak_sales_months`` from ``month_sums``."""
    total = F.sum("monthly_product_sales").cast(sums.schema["monthly_product_sales"].dataType)
    out = sums.groupBy("month").agg(total.alias("monthly_product_sales")).select(
        F.date_format("month", "yyyy-MM").alias("year_month"), "monthly_product_sales")
    return out.orderBy(F.desc("monthly_product_sales"), "year_month") if ordered else out


def top_customers(fact: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` customers with the largest total sales (ties broken by the
    smaller customer_id). Output: customer_id. Bounded to k rows."""
    totals = fact.groupBy("customer_id").agg(F.sum("sales_amount").alias("_total"))
    return top_k(totals, k, [F.desc("_total")], ["customer_id"]).select("customer_id")


def _top_lines(pre: DataFrame, k: int) -> DataFrame:
    """Rows of the top-``k`` customers of an aggregate by (customer_id, _month,
    product_id) with ``monthly_sales``. Totals and rows read the aggregate with
    the same columns, so one shuffle of the fact serves both."""
    totals = pre.groupBy("customer_id").agg(F.sum("monthly_sales").alias("_total"))
    top = top_k(totals, k, [F.desc("_total")], ["customer_id"]).select("customer_id")
    return pre.join(top, "customer_id")


def _attach_products(pre: DataFrame, products: DataFrame, keys: list[str], sums: dict[str, str]) -> DataFrame:
    """Join pre-aggregated rows to products and re-aggregate by ``keys`` + name
    + category, so the result equals aggregating after the join even when a
    product id has several rows. The second aggregate needs no shuffle: the
    join output is already partitioned by a subset of its keys."""
    p = products.select("product_id", F.col("name").alias("product_name"), "category")
    joined = pre.join(p, "product_id")
    return joined.groupBy(*keys, "product_name", "category").agg(
        *[F.sum(src).cast(_sum_type(pre, src) if t is None else t).alias(src)
          for src, t in sums.items()]
    )


def top_customer_products(fact: DataFrame, products: DataFrame, k: int = 5, ordered: bool = True) -> DataFrame:
    """Monthly product sales of the top-``k`` customers.

    Output: customer_id, year_month, product_count (lines; unnamed in the
    reference), product_name, category, monthly_sales; by customer, then
    sales descending. Lines are aggregated per (customer, month, product)
    before the product join, which then carries one row per group.
    """
    pre = fact.groupBy("customer_id", _month_start(), "product_id").agg(
        F.count("product_id").alias("product_count"),
        F.sum("sales_amount").alias("monthly_sales"),
    ).filter(F.col("product_count") >= 0)  # always so: keeps the column in both uses, so that they share a shuffle
    agg = _attach_products(
        _top_lines(pre, k), products, ["customer_id", "_month", "product_id"],
        {"product_count": "bigint", "monthly_sales": _sum_type(fact, "sales_amount")},
    )
    out = agg.select("customer_id", _year_month(), "product_count", "product_name", "category", "monthly_sales")
    return out.orderBy("customer_id", F.desc("monthly_sales")) if ordered else out


def customer_months(fact: DataFrame) -> DataFrame:
    """Per customer and month: orders_per_month (distinct orders),
    monthly_spent, avg_order_value (average line amount)."""
    return fact.groupBy("customer_id", "order_year", "order_month").agg(
        F.count_distinct("order_id").alias("orders_per_month"),
        F.sum("sales_amount").alias("monthly_spent"),
        F.avg("sales_amount").alias("avg_order_value"),
    )


def purchase_trend_of_months(monthly: DataFrame, ordered: bool = True) -> DataFrame:
    """``customer_purchase_trend`` from ``customer_months``."""
    growth = previous_value(
        monthly, "monthly_spent", ["customer_id"], ["order_year", "order_month"], "previous_month_spent"
    )
    out = growth.select(
        "customer_id", "order_year", "order_month", "orders_per_month", "monthly_spent",
        "previous_month_spent",
        pct_change("monthly_spent", "previous_month_spent").alias("spending_growth_pct"),
        "avg_order_value",
    )
    return out.orderBy("customer_id", "spending_growth_pct") if ordered else out


def customer_purchase_trend(fact: DataFrame, ordered: bool = True) -> DataFrame:
    """Per customer and month: orders_per_month (distinct orders),
    monthly_spent, previous_month_spent (previous month *with* sales),
    spending_growth_pct, avg_order_value (average line amount).

    The window runs on the monthly aggregate, so a customer's window
    partition holds at most one row per month whatever its line count.
    """
    return purchase_trend_of_months(customer_months(fact), ordered)


def retention_rate(fact: DataFrame, ordered: bool = True) -> DataFrame:
    """Per order year: total_customers_current_year, retained_customers
    (also bought in the year before), retention_rate_pct.

    Same answer as the reference's self-join on ``year = prev_year + 1``, but
    as ``lag`` over each customer's distinct years: the (customer, year) pairs
    are deduplicated with partial aggregation first, so a window partition
    holds at most one row per year. NULL ids count in neither column.
    """
    years = fact.select("customer_id", "order_year").distinct()
    with_prev = previous_value(years, "order_year", ["customer_id"], ["order_year"], "_prev_year")
    retained = F.col("customer_id").isNotNull() & (F.col("_prev_year") == F.col("order_year") - 1)
    out = (
        with_prev.groupBy(F.col("order_year").alias("current_year"))
        .agg(
            F.count("customer_id").alias("total_customers_current_year"),
            F.count_if(retained).alias("retained_customers"),
        )
        .select(
            "current_year",
            "total_customers_current_year",
            "retained_customers",
            safe_pct("retained_customers", "total_customers_current_year").alias("retention_rate_pct"),
        )
    )
    return out.orderBy("current_year") if ordered else out


def product_months(fact: DataFrame) -> DataFrame:
    """Per product and month: total_quantity_sold, total_sales_amount."""
    return fact.groupBy("order_year", "order_month", "product_id").agg(
        F.sum("quantity").alias("total_quantity_sold"),
        F.sum("sales_amount").alias("total_sales_amount"),
    )


def mom_growth_of_months(monthly: DataFrame, products: DataFrame, ordered: bool = True) -> DataFrame:
    """``product_mom_growth`` from ``product_months``."""
    growth = previous_value(
        monthly, "total_sales_amount", ["product_id"], ["order_year", "order_month"], "previous_month_sales"
    )
    p = products.select("product_id", F.col("name").alias("product_name"), "category")
    out = growth.join(p, "product_id").select(
        "order_year", "order_month", "product_id", "product_name", "category",
        "total_quantity_sold", "total_sales_amount", "previous_month_sales",
        pct_change("total_sales_amount", "previous_month_sales").alias("month_over_month_growth_pct"),
    )
    return out.orderBy("product_id", "order_year", "order_month") if ordered else out


def product_mom_growth(fact: DataFrame, products: DataFrame, ordered: bool = True) -> DataFrame:
    """Per product and month: total_quantity_sold, total_sales_amount,
    previous_month_sales (previous month with sales), growth percent.

    Output: order_year, order_month, product_id, product_name, category,
    total_quantity_sold, total_sales_amount, previous_month_sales,
    month_over_month_growth_pct.
    """
    return mom_growth_of_months(product_months(fact), products, ordered)


def _yoy_pct(curr: Column, prev: Column) -> Column:
    # Kept in the reference's operation order: divide first, then * 100.
    return F.round(
        F.when(prev.isNull() | (prev == 0), F.lit(None)).otherwise((curr - prev) / prev * F.lit(100)),
        2,
    )


def yoy_comparison(fact: DataFrame, products: DataFrame, k: int = 5, ordered: bool = True) -> DataFrame:
    """For the top-``k`` customers: sales per (customer, product, year, month)
    against the same month of the previous year *with* sales.

    Output: customer_id, product_id, product_name, category, sales_year,
    sales_month, monthly_sales, prev_year_sales, yoy_growth_percent.
    """
    pre = fact.groupBy("customer_id", _month_start(), "product_id").agg(F.sum("sales_amount").alias("monthly_sales"))
    lines = _top_lines(pre, k).select(
        "customer_id", "product_id", F.year("_month").alias("sales_year"), F.month("_month").alias("sales_month"),
        "monthly_sales",
    )
    agg = _attach_products(
        lines, products, ["customer_id", "product_id", "sales_year", "sales_month"],
        {"monthly_sales": _sum_type(fact, "sales_amount")},
    )
    with_prev = previous_value(
        agg, "monthly_sales", ["customer_id", "product_id", "sales_month"], ["sales_year"], "prev_year_sales"
    )
    out = with_prev.select(
        "customer_id", "product_id", "product_name", "category", "sales_year", "sales_month",
        "monthly_sales", "prev_year_sales",
        _yoy_pct(F.col("monthly_sales"), F.col("prev_year_sales")).alias("yoy_growth_percent"),
    )
    return out.orderBy("customer_id", F.desc("yoy_growth_percent")) if ordered else out


def customer_segments(current_fact: DataFrame) -> DataFrame:
    """Per customer: purchase_count (lines), total_spent, last_order_date and
    customer_segment by the fixed limits above."""
    agg = current_fact.groupBy("customer_id").agg(
        F.count("order_id").alias("purchase_count"),
        F.sum("sales_amount").alias("total_spent"),
        F.max("order_date").alias("last_order_date"),
    )
    segment = (
        F.when((F.col("purchase_count") >= HIGH_MIN_LINES) & (F.col("total_spent") >= HIGH_MIN_SPENT), SEGMENT_HIGH)
        .when((F.col("purchase_count") >= REGULAR_MIN_LINES) & (F.col("total_spent") >= REGULAR_MIN_SPENT),
              SEGMENT_REGULAR)
        .otherwise(SEGMENT_OCCASIONAL)
    )
    return agg.withColumn("customer_segment", segment)
