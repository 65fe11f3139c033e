"""Reusable shapes: global top-k, top-k per group, previous existing row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def top_k(df: DataFrame, k: int, order: Sequence[Column], tie_break: Sequence[str | Column] = ()) -> DataFrame:
    """First ``k`` rows by ``order`` (then ``tie_break``).

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: every partition
    keeps its own k best rows and one task merges them, so the result and the
    work of the last task are bounded by k × partitions rows.
    """
    return df.orderBy(*order, *_cols(tie_break)).limit(k)


def top_k_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    k: int,
    rank_col: str = "rank",
) -> DataFrame:
    """Rows whose ``rank()`` within ``group`` is at most ``k`` (ties share a
    rank, so a group can return more than k rows).

    The filter on the rank lets Catalyst insert WindowGroupLimit before the
    shuffle: each map partition keeps only its top-k per group, so a group
    with a third of all rows still sends at most k (plus ties) rows per map
    partition to its window task.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.rank().over(w)).filter(F.col(rank_col) <= k)


def previous_value(
    df: DataFrame,
    value: str,
    partition: Sequence[str],
    order: Sequence[str | Column],
    alias: str,
) -> DataFrame:
    """``lag(value)`` over ``partition`` ordered by ``order``: the previous
    *existing* row, so gaps in the ordering key are skipped over.

    Callers apply it to aggregated rows (one per entity and period), which
    bounds every window partition by the number of periods.
    """
    w = Window.partitionBy(*partition).orderBy(*_cols(order))
    return df.withColumn(alias, F.lag(value).over(w))
