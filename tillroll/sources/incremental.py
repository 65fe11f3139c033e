"""Copies of a table that follow its source files.

A copy consists of loads: folders ``<path>/load-<id>``, each with the rows of
some source files. A manifest says which file went into which load, with its
size, time and number of rows. A run compares it with the source's files now:

* nothing changed: nothing is written;
* new files: one more load with their rows;
* files changed or gone: the loads that hold them are dropped, and the files of
  those loads that are still there are copied again with the new ones.

The table is a view over its loads, and the view names its manifest, so one
change of the view publishes all of a run, or none of it. The folders that the
version before used stay until the next run. Once there are ``MOST_LOADS`` loads
all files are copied into one.

Files are told apart by Spark's own metadata columns, so any file source works;
only their footers are read to list them. A filter on the file's path keeps the
other files from being opened.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.quality import check_counts, gate_counts
from tillroll.sources.publish import delete_folder, is_view, new_version, subfolders

MOST_LOADS = 16
MANIFEST = "file string, size long, modified timestamp, n_rows long, load string"
FILE = ["file", "size", "modified"]


@dataclass
class Copied:
    """What a run did: rows of the table now, and files and rows written."""

    rows: int
    files_written: int
    rows_written: int
    version: str | None


def source_files(df: DataFrame) -> DataFrame:
    """file, size, modified, n_rows of each file that a file-based table has
    rows in. No column of the data is read."""
    meta = F.col("_metadata")
    return df.select(
        meta["file_path"].alias("file"), meta["file_size"].alias("size"), meta["file_modification_time"].alias("modified"),
    ).groupBy(*FILE).agg(F.count("*").alias("n_rows"))


def _manifest_path(spark: SparkSession, view: str) -> str | None:
    if not is_view(spark, view):
        return None
    found = spark.sql(f"SHOW TBLPROPERTIES {view}").filter(F.col("key") == "tillroll.manifest").collect()
    return found[0]["value"] if found else None


def follow_table(
    source: DataFrame,
    path: str,
    database: str,
    table: str,
    key: str | None = None,
    gate: bool = True,
    most_loads: int = MOST_LOADS,
) -> Copied:
    """Bring the copy ``database.table`` of ``source`` (a plain scan of files)
    up to date. With ``gate`` an empty table, or a null ``key`` in the rows
    copied now, raises and leaves the copy as it was."""
    spark = source.sparkSession
    path, view, version = path.rstrip("/"), f"{database}.{table}", new_version()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    manifest = _manifest_path(spark, view)
    known = spark.read.schema(MANIFEST).parquet(manifest) if manifest else spark.createDataFrame([], MANIFEST)
    # Both sides have a row a file, as the source's own file index on the driver.
    now = {(r.file, r.size, r.modified): r.n_rows for r in source_files(source).collect()}
    held: dict[str, dict] = {}
    for r in known.collect():
        held.setdefault(r.load, {})[r.file, r.size, r.modified] = r.n_rows
    if manifest and spark.read.table(view).schema != source.schema:
        held = {}   # new columns: every file is copied again
    whole = {load: files for load, files in held.items() if all(f in now for f in files)}
    if len(whole) >= most_loads:
        whole = {}
    kept = {f for files in whole.values() for f in files}
    fresh = {f: n for f, n in now.items() if f not in kept}
    if gate:
        check_counts(table, sum(now.values()), 0)
    if manifest and not fresh and len(whole) == len(held):
        return Copied(sum(now.values()), 0, 0, None)

    load = f"load-{version}"
    try:
        if fresh or not whole:
            _copy(source, f"{path}/{load}", sorted(f for f, _, _ in fresh), sum(fresh.values()), table, key if gate else None)
            whole = whole | {load: fresh}
        lines = [(*f, n, name) for name, files in whole.items() for f, n in files.items()]
        new_manifest = f"{path}/manifest-{version}"
        spark.createDataFrame(lines, MANIFEST).coalesce(1).write.parquet(new_manifest)
        columns = ", ".join(f"`{c}`" for c in source.columns)
        loads = "\nUNION ALL\n".join(f"SELECT {columns} FROM parquet.`{path}/{name}`" for name in whole)
        if not manifest and spark.catalog.tableExists(view):
            spark.sql(f"DROP TABLE {view}")   # a full copy of before: external, its files stay
        spark.sql(f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ('tillroll.manifest' = '{new_manifest}') AS {loads}")
    except Exception:
        for name in (load, f"manifest-{version}"):
            delete_folder(spark, f"{path}/{name}")
        raise
    in_use = {f"{path}/{name}" for name in (*whole, *held)} | {new_manifest, manifest}
    for folder in (*subfolders(spark, path, "load-"), *subfolders(spark, path, "manifest-")):
        if not any(folder.endswith(used.split("/")[-1]) for used in in_use if used):
            delete_folder(spark, folder)
    return Copied(sum(now.values()), len(fresh), sum(fresh.values()), version)


def _copy(source: DataFrame, path: str, files: list[str], n_rows: int, table: str, key: str | None) -> None:
    """Write the rows of some files, as many as were listed."""
    seen = Observation(f"copy:{table}")
    rows = source.filter(F.col("_metadata.file_path").isin(files)) if files else source.limit(0)
    rows.observe(seen, *gate_counts(key)).write.parquet(path)
    counts = seen.get
    if counts["record_count"] != n_rows:
        raise RuntimeError(f"{table}: files changed while they were copied ({counts['record_count']} rows instead of {n_rows})")
    if n_rows:
        check_counts(table, n_rows, counts["null_key_count"], key)
