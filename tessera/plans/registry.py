"""Name -> query builder, and name -> SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``; ``sql`` is its oracle when it has one."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = " ".join(sql.split())
        return fn

    return deco


def r6(c: str | Column) -> Column:
    """Doubles are compared at 6 decimals on both sides."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)
