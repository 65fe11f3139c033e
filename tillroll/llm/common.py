"""Shared helpers: tables, the shared scratch folder, Arrow batch slicing."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 16 << 20  # text handled at once by a Python task
SMALL_SLICE = 2 << 20   # the same where whole rows stay beside it
BATCH_BYTES = 16 << 20  # Arrow batch that Spark sends to a Python task


def tidy(run):
    """A task's function whose worker gives Arrow's unused memory back at the
    end: workers outlive their tasks, and share an executor with others."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
    return wrapped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """What operators with Python tasks need. Arrow batches are limited by
    bytes, so that very long texts do not gather by the ten thousand in one
    task; the package is sent to the executors, once per application."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        if package.is_dir():  # not where it already runs from a shipped archive
            archive = Path(tempfile.mkdtemp(prefix="tillroll-code-")) / "tillroll_code.zip"
            with zipfile.ZipFile(archive, "w") as z:
                for file in sorted(package.rglob("*.py")):
                    z.write(file, file.relative_to(package.parent))
            spark.sparkContext.addPyFile(str(archive))
        _SHIPPED.add(app)


_OWN_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; one of its own only where that
    is unset and the master is local, as in tests."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = _OWN_DIRS.setdefault(context.applicationId, "") or tempfile.mkdtemp(prefix="tillroll-llm-")
        _OWN_DIRS[context.applicationId] = root
    return root.rstrip("/")


def run_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/llm/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, and a lost
    executor loses nothing of it."""
    path = run_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` lacks."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_column(column: str = "text"):
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``limit`` text bytes (a longer
    single text makes a run of its own)."""
    n = batch.num_rows
    if not n:
        return
    offsets = text_buffers(batch.column(column))[0]
    start = 0
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = min(n, max(end, start + 1))
        yield batch.slice(start, end - start)
        start = end


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (int64, n + 1) and UTF-8 bytes of a string array without nulls."""
    if len(texts) == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0]: offsets[-1]]


def texts_of(rows: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The texts of whole rows, null as empty."""
    return rows.column(column).fill_null("")


def row_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SMALL_SLICE) -> Iterator[pa.RecordBatch]:
    """``text_slices`` of whole rows, whose texts may be null."""
    if batch.num_rows:
        sizes = np.diff(text_buffers(texts_of(batch, column))[0])
        run = np.cumsum(sizes) // limit          # a new run with each ``limit`` bytes
        starts = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows]):
            yield batch.slice(a, b - a)
