"""Write, audit, publish: tables that change all at once or not at all.

A table's rows are written to a new folder ``<path>/v-<time>-<id>`` under a
staged name, counted by the write itself (``Observation``: rows and null keys),
checked, and only then published by one change of the catalog: the table's
location moves to the new folder. A write that fails, or whose counts fail the
gate, leaves the published table with its files as they were. The version
before the current one stays, so that queries that have begun go on; older ones
are deleted.

A table with partitions, or whose columns or buckets change, can't just move:
its name changes hands in two steps. If the second fails the first is undone,
and a publish that finds such a leftover puts the old table back before it
starts.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.quality import check_counts, gate_counts

KEEP = 2   # versions of a table that stay: the published one and the one before


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, path: str) -> None:
    folder, fs = _folder(spark, path)
    fs.delete(folder, True)


def subfolders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Paths of the folders under ``path`` whose names start so, by name."""
    folder, fs = _folder(spark, path)
    if not fs.exists(folder):
        return []
    found = [s.getPath() for s in fs.listStatus(folder) if s.isDirectory()]
    return [p.toString() for p in sorted(found, key=lambda p: p.getName()) if p.getName().startswith(prefix)]


def new_version() -> str:
    """A name that sorts by time and is not met twice."""
    return f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def _shape(spark: SparkSession, name: str) -> tuple:
    """What must be equal for a table to take over another one's files."""
    fields = ("Provider", "Num Buckets", "Bucket Columns", "Sort Columns")
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return spark.read.table(name).schema.json(), [(r.col_name, r.data_type) for r in described if r.col_name in fields]


def is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "VIEW"


@dataclass
class Staged:
    """A written table that is not published yet."""

    spark: SparkSession
    path: str
    database: str
    table: str
    version: str
    rows: int
    null_keys: int
    partitioned: bool = False

    @property
    def name(self) -> str:
        return f"{self.database}.{self.table}"

    @property
    def staged_name(self) -> str:
        return f"{self.database}.{_staged(self.table, self.version)}"

    @property
    def location(self) -> str:
        return f"{self.path}/v-{self.version}"

    def read(self) -> DataFrame:
        return self.spark.read.table(self.staged_name)

    def publish(self) -> int:
        """Make this the table, and return its number of rows."""
        spark = self.spark
        if is_view(spark, self.name):   # a copy by changed files of before
            spark.sql(f"DROP VIEW {self.name}")
        if not spark.catalog.tableExists(self.name):
            spark.sql(f"ALTER TABLE {self.staged_name} RENAME TO {self.name}")
        elif not self.partitioned and _shape(spark, self.name) == _shape(spark, self.staged_name):
            spark.sql(f"ALTER TABLE {self.name} SET LOCATION '{self.location}'")
            spark.sql(f"DROP TABLE {self.staged_name}")   # external: its files stay
        else:
            old = f"{self.database}.{_old(self.table)}{uuid.uuid4().hex[:8]}"
            spark.sql(f"ALTER TABLE {self.name} RENAME TO {old}")
            try:
                spark.sql(f"ALTER TABLE {self.staged_name} RENAME TO {self.name}")
            except Exception:
                spark.sql(f"ALTER TABLE {old} RENAME TO {self.name}")
                raise
            spark.sql(f"DROP TABLE {old}")
        spark.catalog.refreshTable(self.name)
        versions = subfolders(spark, self.path, "v-")
        older = [v for v in versions if not v.endswith(f"v-{self.version}")]
        for path in older[: max(0, len(older) - (KEEP - 1))]:
            delete_folder(spark, path)
        return self.rows

    def discard(self) -> None:
        """Remove what was staged; the published table is not touched."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.staged_name}")
        delete_folder(self.spark, self.location)


def _staged(table: str, version: str) -> str:
    return f"{table}__staged_{version.replace('-', '_').lower()}"


def _old(table: str) -> str:
    return f"{table}__old_"


def _put_back(spark: SparkSession, database: str, table: str) -> None:
    """Undo a change of names that a lost driver left half done."""
    if spark.catalog.tableExists(f"{database}.{table}"):
        return
    left = [t.name for t in spark.catalog.listTables(database) if t.name.startswith(_old(table))]
    if left:
        spark.sql(f"ALTER TABLE {database}.{left[0]} RENAME TO {database}.{table}")


def stage_table(
    df: DataFrame,
    path: str,
    database: str,
    table: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] | None = None,
    bucket_by: tuple[int, Sequence[str]] | None = None,
    key: str | None = None,
    gate: bool = True,
) -> Staged:
    """Write ``df`` once to a new version of the table and check it.

    With ``gate`` a ``DataQualityError`` is raised where the write saw no rows
    or a null ``key``. The counts come from the write: no scan of their own.

    ``bucket_by=(n, cols)`` stores the table hash-bucketed and sorted by
    ``cols``. Two tables bucketed the same way on a join key are joined later
    without shuffling either side. The rows are shuffled once here, into one
    file per bucket.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    _put_back(spark, database, table)
    staged = Staged(spark, path.rstrip("/"), database, table, new_version(), 0, 0, bool(partition_by))
    if bucket_by:
        df = df.repartition(bucket_by[0], *bucket_by[1])
    seen = Observation(f"publish:{database}.{table}")
    writer = df.observe(seen, *gate_counts(key)).write.format(fmt).option("path", staged.location)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(bucket_by[0], *bucket_by[1]).sortBy(*bucket_by[1])
    try:
        writer.saveAsTable(staged.staged_name)
        staged.rows, staged.null_keys = int(seen.get["record_count"]), int(seen.get["null_key_count"])
        if gate:
            check_counts(table, staged.rows, staged.null_keys, key)
    except Exception:
        staged.discard()
        raise
    return staged


def publish_table(
    df: DataFrame,
    path: str,
    database: str,
    table: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] | None = None,
    bucket_by: tuple[int, Sequence[str]] | None = None,
    key: str | None = None,
    gate: bool = False,
) -> int:
    """Write ``df`` once as an EXTERNAL catalog table under ``path`` and return
    its number of rows; see ``stage_table``."""
    return stage_table(df, path, database, table, fmt, partition_by, bucket_by, key, gate).publish()


def published_counts(tables: dict[str, Staged]) -> list[tuple[str, int, int, bool]]:
    """(table_name, record_count, null_key_count, passed) as the writes saw them."""
    return [(name, s.rows, s.null_keys, s.rows > 0 and s.null_keys == 0) for name, s in tables.items()]
