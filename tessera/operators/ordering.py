"""Sorts, top-k and ranking.

Global top-k is ``orderBy().limit()`` (planned as TakeOrderedAndProject: each task keeps k
rows). Top-k per group is ``rank() <= k``, which Spark plans with a WindowGroupLimit before
the shuffle, so a hot group sends at most k rows (plus ties) per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(cols: Sequence[str | Column], descending: bool) -> list[Column]:
    out = []
    for c in cols:
        col = F.col(c) if isinstance(c, str) else c
        out.append(col.desc() if descending and isinstance(c, str) else col)
    return out


def sort_desc(df: DataFrame, cols: Sequence[str], tie_break: Sequence[str] = ()) -> DataFrame:
    """All ``cols`` descending, then ``tie_break`` ascending for a total order."""
    return df.orderBy(*_order(cols, True), *tie_break)


def top_k(df: DataFrame, order: Sequence[str | Column], k: int) -> DataFrame:
    """The first k rows in ``order`` (use a unique last key)."""
    return df.orderBy(*order).limit(k)


def rank_within(
    df: DataFrame, group: Sequence[str], order: Sequence[str | Column], name: str = "rank"
) -> DataFrame:
    """``rank()`` inside each group (ties share a rank, the next rank skips)."""
    return df.withColumn(name, F.rank().over(Window.partitionBy(*group).orderBy(*order)))


def top_k_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[str | Column], k: int, name: str = "rank"
) -> DataFrame:
    """Rows ranked ``<= k`` in their group; ties at the cut are all kept."""
    return rank_within(df, group, order, name).where(F.col(name) <= k)
