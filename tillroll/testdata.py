"""Entities built from the driver's generated tables.

The generated tables are TPC-H-like (customer, nation, orders, lineitem, part)
plus an ``events`` stream. The mapping below turns them into the retail
entities the analytics read. It serves the registered queries and the tests;
in production the entities are catalog tables (``CatalogTables``). The oracle
SQL in ``tillroll.plans.oracle`` states the same mapping for DuckDB by itself.

Two clocks: orders run 1995-01-01..2001-08-01 and are seen from ``AS_OF``,
events 2024-01-01..2024-01-30 and are seen from ``EVENTS_AS_OF``, so the event
window reaches the scan as a bound on the raw column.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.sales import lines_of_orders

# Fixed values of the mapping (the oracle SQL uses the same numbers).
AS_OF = dt.date(2001, 8, 1)             # last order date in the generated data
EVENTS_AS_OF = dt.date(2024, 1, 31)     # the day after the last event
HISTORY_BEFORE = dt.date(1998, 1, 1)    # older orders form the history table
PRODUCT_FAMILIES = 20                   # families in the variant of the product mapping


# Declared schemas of the generated tables the mapping reads (no inference).
RAW_SCHEMAS: dict[str, str] = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
             "p_retailprice double"),
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                 "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                 "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    "events": ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
               "props string"),
}


def _k() -> Column:
    return F.col("c_custkey")


def _str(c: Column) -> Column:
    return c.cast("string")


class TestdataTables:
    """Reads ``{sf_dir}/{name}.parquet`` and exposes the retail entities.

    ``product_families=True`` folds lines and parts to ``key % 20`` (a family is
    named after its first part by name and type) so that (customer, product,
    month) recurs across years. All lines and all parts take part.
    """

    __test__ = False  # not a pytest class

    def __init__(self, spark: SparkSession, sf_dir: str, product_families: bool = False):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.product_families = product_families
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """The raw table; the DataFrame (a plan, not data) is built once per
        instance, so file listing and footer reads are not repeated."""
        if name not in self._raw:
            reader = self.spark.read
            if name in RAW_SCHEMAS:
                reader = reader.schema(RAW_SCHEMAS[name])
            self._raw[name] = reader.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._raw[name]

    def table(self, name: str) -> DataFrame:
        builders = {
            "customers": self.customers,
            "orders": self.orders,
            "products": self.products,
            "order_items": self.order_items,
            "sales_orders": self.sales_orders,
            "historical_customer_sales": self.historical_customer_sales,
            "loginhistory": self.loginhistory,
            "enterprisecampaigns": self.enterprisecampaigns,
            "customersupport": self.customersupport,
            "usage_history": self.usage_history,
        }
        return builders[name]()

    # -- customers -----------------------------------------------------------
    def customers(self) -> DataFrame:
        """customer ⋈ nation with messy contact fields derived from the key.

        e-mail classes by ``c_custkey % 10``: 0 has no "@", 1 has no dot after
        the "@" (passes only the as-run pattern), 2 is upper case with blanks,
        the rest are plain. Every third first name is padded, every 50th
        (``% 50 = 7``) last name is NULL.
        """
        k = _k()
        part1 = F.split_part(F.col("c_name"), F.lit("#"), F.lit(1))
        part2 = F.split_part(F.col("c_name"), F.lit("#"), F.lit(2))
        email = (
            F.when(k % 10 == 0, F.concat(F.lit("user"), _str(k), F.lit(".example.com")))
            .when(k % 10 == 1, F.concat(F.lit("user"), _str(k), F.lit("@examplecom")))
            .when(k % 10 == 2, F.concat(F.lit("  USER"), _str(k), F.lit("@Example.COM ")))
            .otherwise(F.concat(F.lit("user"), _str(k), F.lit("@example.com")))
        )
        phone = F.concat(
            F.lit("("), F.lpad(_str(k % 1000), 3, "0"), F.lit(") 555-"),
            F.lpad(_str(k % 10000), 4, "0"),
        )
        nation = self.raw("nation").select("n_nationkey", "n_name")
        return (
            self.raw("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                k.alias("customer_id"),
                F.when(k % 3 == 0, F.concat(F.lit("  "), part1, F.lit(" "))).otherwise(part1).alias("first_name"),
                F.when(k % 50 == 7, F.lit(None).cast("string")).otherwise(part2).alias("last_name"),
                email.alias("email"),
                phone.alias("phone"),
                F.concat(F.lit(" "), _str(k), F.lit(" Market Street  ")).alias("address"),
                F.concat(F.lit("City"), _str(F.col("c_nationkey"))).alias("city"),
                F.col("c_mktsegment").alias("state"),
                (F.lit(10000) + k % 90000).cast("int").alias("zip_code"),
                F.col("n_name").alias("country"),
            )
        )

    # -- orders and lines ----------------------------------------------------
    def orders(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_totalprice").cast("decimal(10,2)").alias("total_amount"),
        )

    def products(self) -> DataFrame:
        part = self.raw("part")
        if self.product_families:
            return part.groupBy((F.col("p_partkey") % PRODUCT_FAMILIES).alias("product_id")).agg(
                F.min("p_name").alias("name"), F.min("p_type").alias("category")
            )
        return part.select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("category"),
        )

    def order_items(self) -> DataFrame:
        """lineitem ⋈ part: unit price is the part's retail price."""
        product = F.col("l_partkey")
        if self.product_families:
            product = product % PRODUCT_FAMILIES
        part = self.raw("part").select("p_partkey", "p_retailprice")
        return (
            self.raw("lineitem")
            .select("l_orderkey", "l_partkey", "l_quantity")
            .join(part, F.col("l_partkey") == F.col("p_partkey"))
            .select(
                F.col("l_orderkey").alias("order_id"),
                product.alias("product_id"),
                F.col("l_quantity").cast("int").alias("quantity"),
                F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
            )
        )

    def timed_orders(self) -> DataFrame:
        """Orders with the time of day, as the sales job gets them."""
        return self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("order_date"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_totalprice").cast("decimal(10,2)").alias("total_amount"),
        )

    def sales_orders(self) -> DataFrame:
        """Orders of the current period (the sales job's ``orders``)."""
        return self.timed_orders().filter(F.col("order_date") >= F.lit(HISTORY_BEFORE))

    def historical_customer_sales(self) -> DataFrame:
        """Lines of orders before ``HISTORY_BEFORE``, stored as a flat table."""
        return self._lines(self.timed_orders().filter(F.col("order_date") < F.lit(HISTORY_BEFORE)))

    def sales_lines(self) -> DataFrame:
        """The full fact as the sales job stores it: lines of all orders, by
        one scan of each table. Equal to ``sales_fact_all`` over the two
        periods, as every priced part is a product (``tests/test_sales.py``)."""
        return self._lines(self.timed_orders())

    def _lines(self, orders: DataFrame) -> DataFrame:
        return lines_of_orders(orders, self.order_items()).select(
            "order_id", "customer_id", "order_date", "product_id", "quantity", "unit_price",
            (F.col("quantity") * F.col("unit_price")).alias("sales_amount"),
            F.year("order_date").alias("order_year"),
            F.month("order_date").alias("order_month"),
        )

    # -- event-derived entities ---------------------------------------------
    def loginhistory(self) -> DataFrame:
        return self.raw("events").select(
            F.col("user_id").alias("customer_id"),
            F.col("ts").alias("login_date"),
            F.concat(F.lit("10.0.0."), F.get_json_object("props", "$.k")).alias("ip_address"),
        )

    def enterprisecampaigns(self) -> DataFrame:
        """A campaign per click and view event, nested. Its interactions: none
        (NULL) where ``event_id % 11 = 0``, an empty array where it is 1, else
        the opening, and after it the click of a click event."""
        event = F.col("event_id")
        channel = F.when(event % 3 == 0, "Email").when(event % 3 == 1, "Web").otherwise("App")

        def interaction(kind: str, action: str) -> Column:
            return F.struct(
                F.concat(_str(event), F.lit(f"-{kind}")).alias("InteractionID"),
                F.col("ts").alias("Timestamp"),
                channel.alias("Channel"),
                F.lit(action).alias("Action"),
            )

        opened, clicked = interaction("o", "Opened"), interaction("c", "Clicked")
        is_click = F.col("event_type") == "click"
        interactions = (
            F.when(event % 11 == 0, F.lit(None))
            .when(event % 11 == 1, F.filter(F.array(opened), lambda x: F.lit(False)))
            .when(is_click, F.array(opened, clicked))
            .otherwise(F.array(opened))
        )
        return self.raw("events").filter(F.col("event_type").isin("click", "view")).select(
            F.col("user_id").alias("CustomerID"),
            F.concat(F.lit("CMP-"), _str(event)).alias("CampaignID"),
            F.struct(F.lit(1).cast("bigint").alias("Opens"), is_click.cast("bigint").alias("Clicks")).alias("Engagement"),
            interactions.alias("Interactions"),
        )

    def customersupport(self) -> DataFrame:
        return (
            self.raw("events")
            .filter(F.col("event_type") == "error")
            .select(
                F.col("user_id").alias("CustomerID"),
                F.col("event_id").alias("TicketID"),
                F.col("ts").alias("Timestamp"),
                F.struct(
                    F.when(F.col("event_id") % 2 == 0, "Open").otherwise("Resolved").alias("Status")
                ).alias("Issue"),
            )
        )

    def usage_history(self) -> DataFrame:
        return self.raw("events").filter(F.col("event_type") == "purchase")
