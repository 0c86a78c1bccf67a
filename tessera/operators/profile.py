"""Profiling aggregates (A01-A16): counts, distinct values, summaries, median, histogram.

Everything is one aggregate plan with partial (map-side) aggregation; nothing is collected.
Single-row results stay DataFrames so callers can join or write them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.positions import exact_quantile


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def table_counts(df: DataFrame, distinct_cols: Sequence[str], ratio_of: str | None = None) -> DataFrame:
    """Row count, exact distinct count per column and rows per distinct value. One
    aggregate per column: several distinct counts in one would copy every row for each of them."""
    out = df.agg(F.count(F.lit(1)).alias("n_rows"))
    for c in distinct_cols:
        out = out.withColumn(f"n_distinct_{c}", df.agg(F.countDistinct(c)).scalar())
    if ratio_of is not None:
        out = out.withColumn(f"rows_per_{ratio_of}", F.try_divide(F.col("n_rows"), F.col(f"n_distinct_{ratio_of}")))
    return out


def distinct_values(df: DataFrame, cols: Sequence[str], sort: bool = False) -> DataFrame:
    """Distinct rows of the given columns (sorted by them with ``sort``, D03)."""
    out = df.select(*cols).distinct()
    return out.orderBy(*cols) if sort else out


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Rows per key (``reduceByKey`` / ``countByValue`` / group size), no group kept."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def ascending_counts(df: DataFrame, key: str, name: str = "n") -> DataFrame:
    """Counts per key ordered by count then key (the argsort of the counts)."""
    return count_by(df, [key], name).orderBy(name, key)


def summary(df: DataFrame, col: str) -> DataFrame:
    """Count, mean, population stdev, max, min and sum (RDD ``stats()``)."""
    x = F.col(col)
    return df.agg(
        F.count(x).alias("n"),
        F.avg(x).alias("mean"),
        F.stddev_pop(x).alias("stdev"),
        F.max(x).alias("max"),
        F.min(x).alias("min"),
        F.sum(x).alias("total"),
    )


def describe_column(df: DataFrame, col: str) -> DataFrame:
    """``describe`` with typed values: count, mean, sample stddev, min, max."""
    x = F.col(col)
    return df.agg(
        F.count(x).alias("n"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("stddev"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
    )


def median(df: DataFrame, col: str, alias: str | None = None) -> DataFrame:
    """A10: exact median (NumPy's interpolation), computed without gathering the column."""
    return exact_quantile(df, col, 0.5, alias or f"median_{col}")


def histogram(df: DataFrame, col: str, bins: int = 20, density: bool = False) -> DataFrame:
    """Equal-width bins between min and max; the last bin is closed on the right.

    Returns every bin (``bin``, ``lo``, ``hi``, ``n`` and, with ``density``, ``density`` =
    n / (total * width)). Min, max and total come from one merged scalar subquery; the bin
    counts are a partial aggregate; the bin table has ``bins`` rows.
    """
    if bins < 1:
        raise ValueError("bins must be >= 1")
    x = F.col(col).cast("double")
    vals = df.select(x.alias("_x")).where(F.col("_x").isNotNull())
    stats = vals.agg(
        F.struct(F.min("_x").alias("lo"), F.max("_x").alias("hi"), F.count(F.lit(1)).alias("total")).alias("s")
    ).scalar()
    # one scalar subquery, attached once as a column; later expressions use the column
    framed = vals.withColumn("_s", stats)
    lo, hi = F.col("_s.lo"), F.col("_s.hi")
    width = (hi - lo) / bins
    raw = F.floor((F.col("_x") - lo) / width).cast("long")
    idx = F.when(width == 0, F.lit(0)).otherwise(F.least(raw, F.lit(bins - 1)))
    counts = framed.select(idx.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    edges = spark.range(bins).withColumnRenamed("id", "bin").withColumn("_s", stats)
    out = edges.join(counts, "bin", "left").select(
        "bin",
        (lo + F.col("bin") * width).alias("lo"),
        (lo + (F.col("bin") + 1) * width).alias("hi"),
        F.coalesce(F.col("n"), F.lit(0)).alias("n"),
        F.col("_s.total").alias("_total"),
        width.alias("_width"),
    )
    if density:
        out = out.withColumn("density", F.try_divide(F.col("n"), F.col("_total") * F.col("_width")))
    return out.drop("_total", "_width")
