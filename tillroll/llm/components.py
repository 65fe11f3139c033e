"""Connected components of an edge table by alternating stars.

Large star hangs every larger neighbour of a node on the smallest node around
it, small star the smaller ones; both keep connectivity, and when nothing
changes every node hangs on the smallest of its component. Each round is two
minima and two joins on the edges, written to the shared folder. Only a count
and a checksum reach the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.filter(F.col("v") > F.col("u")).join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter(F.col("u") != F.col("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).filter(F.col("u") != F.col("v")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` of every node of the edges (columns u, v, long; no
    nulls) that is not the smallest of its component; ``root`` is that."""
    def state(df: DataFrame) -> tuple[int, int]:
        row = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_000_007).alias("h")).first()
        return row["n"], row["h"]

    now = materialize(edges.filter(F.col("u") != F.col("v"))
                      .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    last, seen = None, state(now)
    while last != seen and seen[0]:
        now = materialize(_small_star(_large_star(now)), "stars")
        last, seen = seen, state(now)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
