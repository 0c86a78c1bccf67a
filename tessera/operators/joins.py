"""Joins (J01-J05).

Spark picks hash, sort-merge or broadcast joins by itself, from file statistics and, with AQE,
from real shuffle sizes. An explicit broadcast is only placed on a side whose size is bounded
by a parameter (k centres, k listed terms, one row per partition).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def join_using(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join on shared column names; each key appears once, first."""
    return left.join(right, list(keys), how)


def lookup_join(facts: DataFrame, dim: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """A dictionary lookup as a join; facts without an entry get nulls."""
    return facts.join(dim, list(keys), how)
