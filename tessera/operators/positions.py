"""Global row positions and running totals without a single-partition window.

``row_number() OVER (ORDER BY ...)`` with no ``PARTITION BY`` moves every row into one task.
Here the rows are range-partitioned and sorted by a distributed ``orderBy`` (a hot value of
the first key is spread over several partitions by the later keys), written once to the
reliable checkpoint folder so that partition ids and in-partition order stay fixed, and each
row's position is ``rows in earlier partitions + index inside its partition``. Only one count
per partition travels to a broadcast, a table whose size is bounded by the partition count.

The order must be total (add a unique tie-break key), otherwise positions among equal keys
are arbitrary.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import ensure_checkpoint_dir

_LOCAL_BITS = 33  # monotonically_increasing_id = partition id << 33 | index in partition
_LOCAL_MASK = (1 << _LOCAL_BITS) - 1


def sorted_checkpoint(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Range-partition and sort ``df``, then cut lineage in the shared checkpoint folder.

    The input is held (memory and disk) only while the sort's range sampling and the
    checkpoint write both read it, so it is computed once, then released.
    """
    ensure_checkpoint_dir(df.sparkSession)
    held = df.persist()
    try:
        return held.orderBy(*order).checkpoint(eager=True)
    finally:
        held.unpersist()


def _partition_offsets(sizes: DataFrame, size_col: str) -> DataFrame:
    """Exclusive prefix sums over one row per partition (a table of at most N partitions)."""
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("_pid", F.coalesce(F.sum(size_col).over(w), F.lit(0)).alias("_offset"))


def global_index(df: DataFrame, order: Sequence[str | Column], pos_col: str = "pos") -> DataFrame:
    """Add ``pos_col``: the 0-based position of each row in ``order`` (like sorted zipWithIndex)."""
    fixed = sorted_checkpoint(df, order)
    mid = F.monotonically_increasing_id()
    tagged = fixed.withColumn("_mid", mid).withColumn("_pid", F.shiftright("_mid", _LOCAL_BITS))
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = _partition_offsets(sizes, "_n")
    return (
        tagged.join(F.broadcast(offsets), "_pid")
        .withColumn(pos_col, F.col("_offset") + F.col("_mid").bitwiseAND(F.lit(_LOCAL_MASK)))
        .drop("_mid", "_pid", "_offset")
    )


def _cumsum_in_partition(weight: str, out: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carried = 0
        for pdf in batches:
            cum = pdf[weight].cumsum() + carried
            if len(cum):
                carried = cum.iloc[-1]
            pdf[out] = cum
            yield pdf

    return run


def running_total(
    df: DataFrame, order: Sequence[str | Column], weight_col: str, out_col: str = "running"
) -> DataFrame:
    """Add ``out_col`` = sum of ``weight_col`` over all rows up to and including this one.

    In-partition sums are taken over Arrow batches (no shuffle); partition totals become
    offsets through the bounded broadcast above.
    """
    fixed = sorted_checkpoint(df, order).withColumn("_pid", F.spark_partition_id().cast("long"))
    weight_type = fixed.schema[weight_col].dataType
    if not isinstance(weight_type, (T.LongType, T.IntegerType, T.DoubleType)):
        raise TypeError(f"running_total needs an integral or double weight, got {weight_type}")
    out_schema = T.StructType(fixed.schema.fields + [T.StructField("_local", weight_type, True)])
    local = fixed.mapInPandas(_cumsum_in_partition(weight_col, "_local"), schema=out_schema)
    sizes = fixed.groupBy("_pid").agg(F.sum(weight_col).alias("_w"))
    offsets = _partition_offsets(sizes, "_w")
    return (
        local.join(F.broadcast(offsets), "_pid")
        .withColumn(out_col, F.col("_offset") + F.col("_local"))
        .drop("_pid", "_offset", "_local")
    )


def exact_quantile(
    df: DataFrame, col: str, q: float = 0.5, alias: str | None = None, accuracy: int = 10_000, last_rows: int = 100_000
) -> DataFrame:
    """One-row DataFrame: the exact ``q`` quantile of ``col`` with linear interpolation.

    Same definition as ``percentile``/``median`` (and NumPy's default): position
    ``q * (n - 1)`` in sorted order. An approximate percentile brackets the two ranks asked for,
    the rows below the bracket are counted, and the same is done inside it until at most
    ``last_rows`` rows (or one value) are left; only those are sorted. Each round is an
    aggregate over the column that shrinks the bracket by a factor of about ``accuracy / 4``.
    """
    if not 0.0 <= q <= 1.0:
        raise ValueError("q must be in [0, 1]")
    alias = alias or f"q_{col}"
    x = F.col("_x")
    rows = df.select(F.col(col).alias("_x")).where(x.isNotNull())
    inside, below = rows.count(), 0
    if not inside:
        return rows.agg(F.max(x).cast("double").alias(alias))
    at = q * (inside - 1)
    low, high = int(at), min(int(at) + (at > int(at)), inside - 1)
    held = rows
    while inside > last_rows:
        margin = 2.0 / accuracy
        shares = [max(0.0, (low - below) / inside - margin), min(1.0, (high + 1 - below) / inside + margin)]
        a, b = held.agg(F.percentile_approx(x, shares, accuracy).alias("p")).first()["p"]
        under, upto = held.agg(F.count_if(x < a).alias("u"), F.count_if(x <= b).alias("t")).first()
        if under > low - below:  # the approximation missed on this side: keep the old bound
            a, under = held.agg(F.min(x)).first()[0], 0
        if upto <= high - below:
            b, upto = held.agg(F.max(x)).first()[0], inside
        held = rows.where(x.between(a, b))
        shrunk = upto - under < inside
        below, inside = below + under, upto - under
        if a == b or not shrunk:
            break
    # few distinct values or few rows are left
    counts = held.groupBy(x).agg(F.count(F.lit(1)).alias("_c"))
    upto = F.sum("_c").over(Window.orderBy("_x")) + F.lit(below)
    ranked = counts.select(x.cast("double").alias("_v"), upto.alias("_t"), F.col("_c"))
    first = F.col("_t") - F.col("_c")
    pick = lambda k: F.max(F.when((first <= k) & (F.lit(k) < F.col("_t")), F.col("_v")))
    lo, hi = pick(low), pick(high)
    return ranked.agg((lo + (hi - lo) * F.lit(at - low)).alias(alias))
