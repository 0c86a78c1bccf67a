"""Feature building (M01-M08, M19): category indexes, one-hot, vocabulary, bag of words,
imputation, scaling, assembling.

Two forms are offered for the indexers: plain DataFrame plans (mapping tables that are
joined back, sized by the number of distinct values, never collected), and the Spark ML
stages (``StringIndexer``, ``OneHotEncoder``, ``Imputer``, ``StandardScaler``,
``VectorAssembler``) for use inside an ML ``Pipeline``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import (
    Imputer,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.strings import split_literal
from tessera.operators.positions import global_index


def frequency_index_table(df: DataFrame, col: str, index_col: str | None = None) -> DataFrame:
    """``(col, index, n)``: index 0 is the most frequent value, ties alphabetical.

    Same order as ``StringIndexer(stringOrderType='frequencyDesc')`` in Spark 4.
    """
    index_col = index_col or f"{col}_index"
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return global_index(counts, [F.desc("n"), F.col(col)], index_col)


def frequency_index(df: DataFrame, col: str, index_col: str | None = None) -> DataFrame:
    """Add the frequency index of ``col`` to every row (rows with null keep null)."""
    index_col = index_col or f"{col}_index"
    mapping = frequency_index_table(df, col, index_col).select(col, index_col)
    return df.join(mapping, col, "left")


def one_hot(df: DataFrame, index_cols: Sequence[str], drop_last: bool = True, suffix: str = "_vec") -> DataFrame:
    """One-hot sparse vectors; the last category is dropped by default (size = n - 1)."""
    enc = OneHotEncoder(
        inputCols=list(index_cols), outputCols=[c + suffix for c in index_cols], dropLast=drop_last
    )
    return enc.fit(df).transform(df)


def term_vocabulary(df: DataFrame, text_col: str, sep: str = " ", id_col: str = "term_id") -> DataFrame:
    """Distinct terms of the text split on ``sep``, numbered 0.. in term order."""
    terms = df.select(F.explode(split_literal(text_col, sep)).alias("term")).distinct()
    return global_index(terms, ["term"], id_col)


def binary_bag(
    df: DataFrame, key: str, text_col: str, vocab: DataFrame, sep: str = " ", id_col: str = "term_id"
) -> DataFrame:
    """The sparse 0/1 term vector of each row as ``(key, term_id, value=1.0)``.

    The vocabulary is joined, not shipped in a closure. Repeats go within the row's own array, so
    rows are not shuffled to drop them; ``key`` identifies a row.
    """
    pairs = df.select(key, F.explode(F.array_distinct(split_literal(text_col, sep))).alias("term"))
    return pairs.join(vocab, "term").select(
        key, id_col, F.lit(1.0).alias("value")
    )


def fill_sentinel_with_mean(df: DataFrame, col: str, sentinel, out: str | None = None) -> DataFrame:
    """Replace every ``sentinel`` value with the mean of the other values (as double)."""
    out = out or col
    known_mean = df.where(F.col(col) != sentinel).agg(F.avg(col)).scalar()
    return df.withColumn(out, F.when(F.col(col) == sentinel, known_mean).otherwise(F.col(col).cast("double")))


def impute_mean(df: DataFrame, cols: Sequence[str], missing_value: float = 0.0, suffix: str = "") -> DataFrame:
    """ML ``Imputer`` (mean of the non-missing values), in place when ``suffix`` is empty."""
    imp = Imputer(
        inputCols=list(cols),
        outputCols=[c + suffix for c in cols],
        strategy="mean",
        missingValue=missing_value,
    )
    return imp.fit(df).transform(df)


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """``VectorAssembler``; invalid (null/NaN) input raises, as in the source."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error").transform(df)


def standardize(df: DataFrame, vec_col: str, out: str = "scaled", with_mean: bool = True) -> DataFrame:
    """``StandardScaler`` with the sample standard deviation."""
    scaler = StandardScaler(inputCol=vec_col, outputCol=out, withMean=with_mean, withStd=True)
    return scaler.fit(df).transform(df)
