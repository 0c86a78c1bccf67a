"""Deterministic data splits.

Positions come from :mod:`tessera.operators.positions` (distributed sort + per-partition
offsets), never from a window without ``PARTITION BY``; per-key ordinals are taken as
``global position - first position of the key``, so a key holding a third of the rows is
still spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.positions import global_index


def hash_split(df: DataFrame, keys: Sequence[str], train_share: int = 8, buckets: int = 10, seed: int = 42) -> Column:
    """L20, partition-independent: ``'train'`` when the first 32 bits of ``md5(seed|key|...)``, modulo
    ``buckets``, are below ``train_share``.

    Unlike ``randomSplit`` the side of a row does not depend on partitioning or task retries,
    and any engine with md5 gives the same sides.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    h = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % buckets
    return F.when(h < train_share, F.lit("train")).otherwise(F.lit("test"))


def positional_folds(df: DataFrame, order: Sequence[str], k: int = 5, fold_col: str = "fold") -> DataFrame:
    """Contiguous blocks of ``ceil(n / k)`` rows in ``order``; fold ``i`` is test set ``i``."""
    if k < 1:
        raise ValueError("k must be >= 1")
    n = df.agg(F.count(F.lit(1))).scalar()
    block = F.ceil(n / F.lit(k))
    indexed = global_index(df, order, "_pos")
    return indexed.withColumn(fold_col, F.floor(F.col("_pos") / block).cast("long")).drop("_pos")


def fold_split(folded: DataFrame, i: int, fold_col: str = "fold") -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` for split ``i``: test is fold ``i``, train is every other fold."""
    return folded.where(F.col(fold_col) != i), folded.where(F.col(fold_col) == i)


def ordinal_within(df: DataFrame, key: str, order: Sequence[str], name: str = "ordinal") -> DataFrame:
    """1-based ordinal of each row inside its ``key`` in ``order`` (skew-safe)."""
    indexed = global_index(df, [key, *order], "_gpos")
    starts = indexed.groupBy(key).agg(F.min("_gpos").alias("_start"))  # one row per key
    # joined by shuffle, AQE splits a hot key's partition
    return (
        indexed.join(starts, key)
        .withColumn(name, (F.col("_gpos") - F.col("_start") + 1).cast("long"))
        .drop("_gpos", "_start")
    )


def holdout_per_key(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    start: int,
    stop: int,
    max_test: int,
    id_col: str,
    part_col: str = "part",
) -> DataFrame:
    """Rows ``start..stop`` (1-based) of each key go to ``test``, but only the first
    ``max_test`` such rows in ``order`` overall (``max_test <= 0``: no cap); the rest ``base``.

    ``order`` is the file order (e.g. an event id) and ``id_col`` must identify a row. The rank is
    limited before the shuffle (``WindowGroupLimit``), so a key with a third of all rows sends
    at most ``stop`` rows per task; the first ``max_test`` rows overall are a top-k.
    """
    rows = df.select(key, id_col, *[c for c in order if c not in (id_col, key)])
    ranked = rows.withColumn("_k", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    qualifying = ranked.where(F.col("_k") <= stop).where(F.col("_k") >= start)
    if max_test > 0:
        qualifying = qualifying.orderBy(*order).limit(max_test)
    chosen = qualifying.select(id_col, F.lit(True).alias("_test"))
    return (
        df.join(chosen, id_col, "left")
        .withColumn(part_col, F.when(F.col("_test"), F.lit("test")).otherwise(F.lit("base")))
        .drop("_test")
    )
