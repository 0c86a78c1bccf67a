"""Hourly demand regression over a CSV with a header (the source's regression script):
eight categories one-hot (linear model) or as indices (trees), four weather numbers,
label = the hourly count; casual + registered are dropped (they sum to the label).
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.dates import iso_weekday, weekend_flag
from tessera.operators import models
from tessera.operators.splits import hash_split

SCHEMA = (
    "instant INT, dteday DATE, season INT, yr INT, mnth INT, hr INT, holiday INT, weekday INT, workingday INT, "
    "weathersit INT, temp DOUBLE, atemp DOUBLE, hum DOUBLE, windspeed DOUBLE, casual INT, registered INT, cnt INT"
)
CATEGORIES = ["season", "yr", "mnth", "hr", "holiday", "weekday", "workingday", "weathersit"]
NUMBERS = ["temp", "atemp", "hum", "windspeed"]


def prepare(hours: DataFrame) -> DataFrame:
    """Drop casual and registered, label = cnt, ISO weekday and weekend flag
    from the date (columns chosen by name, D10/D11)."""
    return (
        hours.drop("casual", "registered")
        .withColumnRenamed("cnt", "label")
        .withColumn("label", F.col("label").cast("double"))
        .withColumn("iso_weekday", iso_weekday("dteday"))
        .withColumn("isWeekend", weekend_flag("dteday"))
    )


def _index():
    return StringIndexer(inputCols=CATEGORIES, outputCols=[c + "_idx" for c in CATEGORIES], handleInvalid="keep")


def onehot_stages():
    return [
        _index(),
        OneHotEncoder(inputCols=[c + "_idx" for c in CATEGORIES], outputCols=[c + "_vec" for c in CATEGORIES]),
        VectorAssembler(inputCols=[c + "_vec" for c in CATEGORIES] + NUMBERS, outputCol="features"),
    ]


def index_stages():
    return [VectorAssembler(inputCols=CATEGORIES + NUMBERS, outputCol="features")]


def compare_regressors(hours: DataFrame, seed: int = 42) -> DataFrame:
    """``(model, features, metric, value)``: linear regression (10
    iterations, reg 0.3, elastic net 0.8) and the tree models with and without one-hot
    categories, plus linear regression on log(label) taken back through exp."""
    data = prepare(hours)
    data = data.withColumn("_part", hash_split(data, ["instant"], seed=seed))
    train, test = data.where(F.col("_part") == "train").persist(), data.where(F.col("_part") == "test")
    fits = [("linear_regression", "onehot", onehot_stages(), models.linear_regression()),
            ("linear_regression", "index", index_stages(), models.linear_regression())]
    for name, est in models.tree_regressors(seed=seed).items():
        fits.append((name, "index", index_stages(), est))
    for name, est in models.tree_regressors(seed=seed).items():
        fits.append((name, "onehot", onehot_stages(), est))
    rows = []
    try:
        for name, fs, stages, est in fits:
            _, pred = models.fit_and_score(stages + [est], train, test)
            rows.append(_scores(name, fs, pred))
        _, log_pred = models.fit_and_score(
            onehot_stages() + [models.linear_regression(label="log_label")], models.log_target(train.where(F.col("label") > 0)), test
        )
    finally:
        train.unpersist()
    rows.append(_scores("linear_regression_log_target", "onehot", models.exp_back(log_pred)))
    return reduce(DataFrame.unionByName, rows)


def _scores(name, fs, pred):
    out = models.value_metrics(name, pred).withColumn("features", F.lit(fs))
    return out.select("model", "features", "metric", "value")
