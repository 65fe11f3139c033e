"""Proof that written files hold the order that they were sorted in.

A sorted result is a folder of files, ``part-00000`` before ``part-00001``, with
rows in order within each. Rows are compared with the one before in their file
(by the reader's own row numbers, over row groups), and each file's first row
with the last of the file before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

Key = tuple[str, bool]   # column, ascending


def _after(before: Column, here: Column, keys: Sequence[Key]) -> Column:
    """Whether ``before`` sorts after ``here``; nulls first ascending, last descending."""
    wrong, equal = F.lit(False), F.lit(True)
    for name, ascending in keys:
        a, b = (before[name], here[name]) if ascending else (here[name], before[name])
        wrong = wrong | (equal & (F.coalesce(a > b, F.lit(False)) | (a.isNotNull() & b.isNull())))
        equal = equal & before[name].eqNullSafe(here[name])
    return wrong


def out_of_order(spark: SparkSession, path: str, keys: Sequence[Key]) -> DataFrame:
    """file, row: the rows of a Parquet folder that sort before the row ahead of
    them. No rows: the folder is in order.

    Rows of a file are compared in one partition each, sorted by a number that
    they are read in; files by a row each."""
    names = [name for name, _ in keys]
    rows = spark.read.parquet(path).select(
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"), F.struct(*names).alias("key"))
    in_file = Window.partitionBy("file").orderBy("row")
    inner = rows.withColumn("before", F.lag("key").over(in_file))
    edges = rows.groupBy("file").agg(F.min("row").alias("row"), F.min_by("key", "row").alias("key"), F.max_by("key", "row").alias("last"))
    # One row a file.
    outer = edges.select("file", "row", "key", F.lag("last").over(Window.orderBy("file")).alias("before"))
    both = inner.select("file", "row", "key", "before").unionByName(outer)
    return both.filter(F.col("before").isNotNull() & _after(F.col("before"), F.col("key"), keys)).select("file", "row")
