"""Where entities come from: a metastore database or a folder of tables."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame, SparkSession


class Tables(Protocol):
    """Anything that returns an entity DataFrame by name."""

    def table(self, name: str) -> DataFrame: ...


class CatalogTables:
    """``spark.read.table(f"{database}.{name}")``; Catalyst prunes columns and
    pushes filters into the underlying scan."""

    def __init__(self, spark: SparkSession, database: str):
        self.spark = spark
        self.database = database

    def table(self, name: str) -> DataFrame:
        return self.spark.read.table(f"{self.database}.{name}")


class SessionTables:
    """Temp views or tables already known to the session, by name
    (``spark.table``); names resolve case-insensitively, so the views the
    reference registers (``orders``, ``LoginHistory``, ...) can be used as
    they are. ``aliases`` maps entity names to view names."""

    def __init__(self, spark: SparkSession, aliases: dict[str, str] | None = None):
        self.spark = spark
        self.aliases = aliases or {}

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self.aliases.get(name, name))


class ParquetTables:
    """One parquet folder (or file) per entity under ``root``."""

    def __init__(self, spark: SparkSession, root: str, suffix: str = ""):
        self.spark = spark
        self.root = root.rstrip("/")
        self.suffix = suffix

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}{self.suffix}")


class MappedTables:
    """Entities given directly as DataFrames (tests, notebooks)."""

    def __init__(self, frames: dict[str, DataFrame]):
        self.frames = frames

    def table(self, name: str) -> DataFrame:
        return self.frames[name]
