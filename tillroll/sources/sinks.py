"""Writers. Each output is computed once: row counts come from an
``Observation`` attached to the write instead of separate ``count()`` and
``show()`` actions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def _observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def write_output(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
) -> int:
    """Write ``df`` to ``path`` in one job and return the number of rows written."""
    observed, obs = _observed(df, f"write:{path}")
    writer = observed.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return int(obs.get["rows"])


def write_outputs(
    outputs: Mapping[str, DataFrame],
    base_path: str,
    fmt: str = "parquet",
    concurrency: int = 1,
) -> dict[str, int]:
    """Write several named datasets under ``base_path/<name>``.

    With ``concurrency > 1`` independent writes are submitted from that many
    driver threads, so the scheduler can fill cores that one output's small
    stages leave idle; each output is still one job, written once.
    """
    root = base_path.rstrip("/")
    if concurrency <= 1:
        return {name: write_output(df, f"{root}/{name}", fmt) for name, df in outputs.items()}
    with ThreadPoolExecutor(max_workers=concurrency) as pool:
        futures = {name: pool.submit(write_output, df, f"{root}/{name}", fmt) for name, df in outputs.items()}
        return {name: f.result() for name, f in futures.items()}
