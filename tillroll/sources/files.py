"""File readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_files(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    options: dict[str, str] | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Generic reader: ``spark.read.format(fmt).options(**options).load(path)``.

    CSV defaults to ``header=true``. Without a schema every CSV column is a
    string (no inference pass over the data); give a schema to type them.
    """
    opts = {"header": "true"} if options is None else dict(options)
    reader = spark.read.format(fmt).options(**opts)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_csv_with_header(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Header CSV, all columns string unless a schema is given."""
    return read_files(spark, path, "csv", {"header": "true"}, schema)
