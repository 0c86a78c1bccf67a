"""Page classification over a quoted TSV with text columns, numeric text columns that may
hold ``"?"`` and a ``label`` (the source's classification script).

Each classifier is scored on four feature sets, as the source compares them: the cleaned
numbers, the numbers with 0 imputed by the mean in the first seven, those standardised, and
those plus the one-hot category. Naive Bayes only sees the unscaled sets (D07).
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.numeric import clean_numeric
from tessera.operators import models
from tessera.operators.features import impute_mean
from tessera.operators.splits import hash_split

N_TEXT_COLUMNS = 4  # url, urlid, boilerplate, category come first
N_IMPUTED = 7


def clean_table(raw: DataFrame, category: str = "alchemy_category", label: str = "label") -> DataFrame:
    """Every column after the text ones cleaned to a double (one projection),
    the label as an integer and the category with its quotes removed."""
    text_cols = raw.columns[:N_TEXT_COLUMNS]
    if category not in text_cols:
        raise ValueError(f"{category!r} must be one of the leading text columns {text_cols}")
    numeric_cols = [c for c in raw.columns[N_TEXT_COLUMNS:] if c != label]
    return raw.select(
        *[F.replace(F.col(c), F.lit('"'), F.lit("")).alias(c) if c == category else F.col(c) for c in text_cols],
        *[clean_numeric(c).alias(c) for c in numeric_cols],
        F.col(label).cast("string").try_cast("int").alias(label),
    )


def feature_sets(clean: DataFrame, category: str = "alchemy_category", label: str = "label") -> DataFrame:
    """Adds ``f_raw``, ``f_imputed``, ``f_scaled`` and ``f_category`` vectors."""
    numeric_cols = [c for c in clean.columns[N_TEXT_COLUMNS:] if c != label]
    imputed_cols = [f"{c}__imp" for c in numeric_cols[:N_IMPUTED]]
    df = impute_mean(clean, numeric_cols[:N_IMPUTED], 0.0, suffix="__imp")
    df = StringIndexer(inputCol=category, outputCol="category_idx", handleInvalid="keep").fit(df).transform(df)
    df = OneHotEncoder(inputCols=["category_idx"], outputCols=["category_vec"]).fit(df).transform(df)
    rest = numeric_cols[N_IMPUTED:]
    df = VectorAssembler(inputCols=numeric_cols, outputCol="f_raw").transform(df)
    df = VectorAssembler(inputCols=imputed_cols + rest, outputCol="f_imputed").transform(df)
    df = StandardScaler(inputCol="f_imputed", outputCol="f_scaled", withMean=True, withStd=True).fit(df).transform(df)
    df = VectorAssembler(inputCols=["f_scaled", "category_vec"], outputCol="f_category").transform(df)
    return df.withColumn(label, F.col(label).cast("double"))


def compare_classifiers(raw: DataFrame, id_col: str = "urlid", label: str = "label", seed: int = 42) -> DataFrame:
    """``(model, features, metric, value)`` for every classifier and feature
    set, on a hash split of ``id_col`` (80 % train)."""
    data = feature_sets(clean_table(raw, label=label), label=label)
    data = data.withColumn("_part", hash_split(data, [id_col], seed=seed))
    test = data.where(F.col("_part") == "test")
    candidates = {
        "logistic_regression": (models.logistic_regression, ["f_raw", "f_imputed", "f_scaled", "f_category"]),
        "linear_svc": (models.linear_svc, ["f_raw", "f_imputed", "f_scaled", "f_category"]),
        "naive_bayes": (models.naive_bayes, ["f_raw", "f_imputed"]),
        "random_forest": (models.random_forest_classifier, ["f_raw", "f_imputed", "f_scaled", "f_category"]),
    }
    rows = []
    held = data.where(F.col("_part") == "train").persist()  # read by every fit, released after the last
    try:
        for name, (make, sets) in candidates.items():
            for fs in sets:
                pred = make(features=fs, label=label).fit(held).transform(test)
                rows.append(models.class_metrics(name, pred, label).withColumn("features", F.lit(fs)))
    finally:
        held.unpersist()
    return reduce(DataFrame.unionByName, rows).select("model", "features", "metric", "value")
