"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins and partition counts at run
# time (broadcast only when the measured side is under the threshold, skewed
# join partitions split, small shuffle partitions coalesced).
DEFAULT_CONF: dict[str, str] = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when the join output feeds an
    # aggregate on the join key (splitting then costs one extra shuffle of the
    # join output; without it one task would take the whole hot key).
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "tillroll",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
    shuffle_bytes: int | None = None,
    total_cores: int | None = None,
) -> SparkSession:
    """Get or create a session with the defaults above.

    ``master`` is only set when given (on a cluster the launcher sets it).
    With ``shuffle_bytes`` (the largest shuffle of the run) and ``total_cores``
    partitions are sized by ``scale_conf``; ``shuffle_partitions`` sets their
    number directly. AQE coalesces it down for small stages.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    merged = dict(DEFAULT_CONF)
    if shuffle_bytes and total_cores:
        merged.update(scale_conf(shuffle_bytes, total_cores))
    if shuffle_partitions:
        merged["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    merged.update(conf or {})
    for key, value in merged.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


MB = 1 << 20


def scale_conf(shuffle_bytes: int, total_cores: int, partition_bytes: int = 256 * MB) -> dict[str, str]:
    """Partition sizing for a cluster run.

    ``shuffle_bytes`` is the largest shuffle of the run (for the sales fact,
    roughly its compressed width × lines); ``total_cores`` is executors ×
    cores. The initial shuffle partition count gives ``partition_bytes`` per
    task and at least two waves of tasks; AQE then coalesces small stages to
    the same advisory size and splits partitions over four times it. Scans
    split files to the same size, so a task's input fits in executor memory
    with room for sort and aggregation buffers (spill, not OOM, beyond).
    Example: 30 TB of shuffle on 8,000 cores -> 111,759 partitions of 256 MiB.
    """
    partitions = max(2 * total_cores, -(-shuffle_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.2",
    }


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for materialised intermediates, from
    ``spark.checkpoint.dir``. Unset is an error: a machine-local folder would
    leave each executor writing to its own disk."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise RuntimeError("spark.checkpoint.dir must name a shared folder")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder."""
    return os.path.join(checkpoint_root(spark), *parts)
