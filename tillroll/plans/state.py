"""Stored results that follow new rows without reading the old ones again."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import operators as op
from tillroll.sources.publish import delete_folder, stage_table, subfolders

MONTH = ["order_year", "order_month"]

# Name of a table of sums, and what makes it from the fact.
SUMS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "months": op.month_sums,
    "customers": op.customer_months,
    "products": op.product_months,
}


def touched_months(lines: DataFrame) -> list[tuple[int | None, int | None]]:
    """The (year, month) pairs of some lines: at most as many as there are months."""
    return [tuple(r) for r in lines.select(*MONTH).distinct().collect()]


def of_months(months: list[tuple[int | None, int | None]]) -> Column:
    """A filter that prunes the partitions of a table by year and month."""
    return reduce(lambda a, b: a | b, (
        F.col("order_year").eqNullSafe(F.lit(y).cast("int")) & F.col("order_month").eqNullSafe(F.lit(m).cast("int")) for y, m in months
    ), F.lit(False))


class MonthlySums:
    """Sums per month, per customer and month, and per product and month, in
    three tables under ``path`` partitioned by year and month.

    A month is always summed as a whole from the fact, which is partitioned the
    same way: a late line in an old month or a deleted one costs that month
    alone, and an update that is repeated, or was broken off, gives the same
    sums. A month takes its place in a table at once."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def update(self, fact: DataFrame, months: list[tuple[int | None, int | None]] | None = None) -> None:
        """Sum ``months`` anew from ``fact``; all that it has where None."""
        lines = fact if months is None else fact.filter(of_months(months))
        for name, sums in SUMS.items():
            sums(lines).hint("rebalance", *MONTH).write.mode("overwrite").option(
                "partitionOverwriteMode", "static" if months is None else "dynamic"
            ).partitionBy(*MONTH).parquet(f"{self.path}/{name}")
        # Months without lines any more have written nothing: their sums go.
        left = set(touched_months(lines)) if months else set()
        for year, month in set(months or ()) - left:
            for name in SUMS:
                for folder in subfolders(self.spark, f"{self.path}/{name}", f"order_year={_named(year)}"):
                    delete_folder(self.spark, f"{folder}/order_month={_named(month)}")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")


def _named(value: int | None) -> str:
    return "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)


class ChurnState:
    """``customer_orders`` of all orders so far, as the table ``database.table``.

    ``through`` marks how far the merged orders go: a value that sorts as the
    batches come (a date, a batch number with zeros). It is stored in the rows,
    so it changes with them at once; a batch up to it is in the state already
    and changes nothing when it comes again. Batches share no order."""

    def __init__(self, spark: SparkSession, path: str, database: str, table: str = "customer_orders"):
        self.spark, self.path, self.database, self.table = spark, path, database, table

    @property
    def name(self) -> str:
        return f"{self.database}.{self.table}"

    def read(self) -> DataFrame:
        return self.spark.read.table(self.name).drop("through")

    def merge(self, new_orders: DataFrame, through: str) -> bool:
        """Add a batch; False if the state has it."""
        newer = op.customer_orders(new_orders)
        if self.spark.catalog.tableExists(self.name):
            held = self.spark.read.table(self.name).agg(F.max("through")).first()[0]
            if held is not None and through <= held:
                return False
            newer = op.merge_customer_orders(self.read(), newer)
        stage_table(newer.withColumn("through", F.lit(through)), self.path, self.database, self.table, gate=False).publish()
        return True
