"""Models and evaluation (L01-L19): Spark ML estimators in pipelines, metrics as aggregates.

Fits run on Spark ML (distributed, partial aggregates per iteration); nothing is collected
except the fitted parameters. Metrics are plain aggregates over ``(label, prediction)`` so
they can be computed and compared as DataFrames; the ML evaluators give the same numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import LinearSVC, LogisticRegression, NaiveBayes, RandomForestClassifier
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.arrays import array_mean, squared_distance
from tessera.functions.numeric import squared_log_error
from tessera.operators.boosting import BoostedTrees
from tessera.operators.positions import global_index
from tessera.session import written

# ---- metrics (L17-L19, F13) -------------------------------------------------------------


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of rows whose prediction equals the label."""
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def weighted_recall(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Recall per class weighted by class size (sum over classes of TP_c / N)."""
    per_class = df.groupBy(label).agg(
        F.count(F.lit(1)).alias("n_c"), F.sum((F.col(label) == F.col(prediction)).cast("double")).alias("tp")
    )
    return per_class.agg(F.try_divide(F.sum("tp"), F.sum("n_c")).alias("weighted_recall"))


def rmse(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Root mean squared error."""
    return df.agg(F.sqrt(F.avg(F.pow(F.col(prediction) - F.col(label), 2))).alias("rmse"))


def rmsle(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """root mean squared log error, ``sqrt(avg((log(p+1) - log(a+1))^2))``."""
    return df.agg(F.sqrt(F.avg(squared_log_error(prediction, label))).alias("rmsle"))


# ---- recommendation (L01, L02) ------------------------------------------------------------

#: Ratings that a block of a factorisation holds, about: a task has one block in memory, and the factors it meets.
BLOCK_ROWS = 2_000_000


def als_blocks(rows: int, least: int = 10) -> int:
    """Blocks of a factorisation of so many ratings: ``least``, and beyond that as many as keep a block's size. They
    follow from the data alone, so the factors do not change with the cluster's size."""
    return max(least, -(-rows // BLOCK_ROWS))


def als(
    ratings: DataFrame,
    user: str,
    item: str,
    rating: str,
    rank: int = 10,
    max_iter: int = 5,
    reg: float = 0.01,
    seed: int = 42,
    blocks: int = 10,
):
    """Explicit-feedback ALS; unseen users/items are dropped at prediction time.

    ``blocks``: user and item blocks, at least; more ratings have more (:func:`als_blocks`). It is not taken
    from the session, so the factors do not change with the cluster's size. Ids must be ints: index
    larger ones densely first (``dense_ids``).
    """
    blocks = als_blocks(ratings.count(), blocks)
    est = ALS(
        rank=rank, maxIter=max_iter, regParam=reg, userCol=user, itemCol=item, ratingCol=rating,
        coldStartStrategy="drop", seed=seed, numUserBlocks=blocks, numItemBlocks=blocks, checkpointInterval=1,  # frees shuffles
    )
    return est.fit(ratings)


def dense_ids(df: DataFrame, col: str, out: str) -> DataFrame:
    """``(col, out)``: the distinct values of ``col`` numbered 0.. in order, as ints, whatever their size."""
    return global_index(df.select(col).distinct(), [col], out).withColumn(out, F.col(out).cast("int"))


def factor_means(model) -> DataFrame:
    """``(kind, id, f_mean)`` mean of each user's and item's factor vector."""
    users = model.userFactors.select(F.lit("user").alias("kind"), "id", array_mean("features").alias("f_mean"))
    items = model.itemFactors.select(F.lit("item").alias("kind"), "id", array_mean("features").alias("f_mean"))
    return users.unionByName(items)


# ---- clustering (L03-L05, A18) ------------------------------------------------------------


def kmeans(df: DataFrame, k: int = 5, seed: int = 1, features: str = "features", prediction: str = "prediction"):
    """L03."""
    return KMeans(k=k, seed=seed, featuresCol=features, predictionCol=prediction).fit(df)


def bisecting_kmeans(df: DataFrame, k: int = 5, seed: int = 1, features: str = "features", prediction: str = "prediction"):
    """Fit input must not already hold ``prediction`` (D12): pass another name."""
    return BisectingKMeans(k=k, seed=seed, featuresCol=features, predictionCol=prediction).fit(df)


def centre_table(model, spark) -> DataFrame:
    """``(prediction, centre array)``, k rows (parameters of the fitted model)."""
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, "prediction int, centre array<double>")


def distance_to_centre(
    assigned: DataFrame, centres: DataFrame, features_arr: str, key: str = "prediction", out: str = "dist"
) -> DataFrame:
    """Squared distance of each row to its own centre (centres: one row per cluster,
    broadcast: the table has k rows)."""
    return assigned.join(F.broadcast(centres), key).withColumn(out, squared_distance(features_arr, "centre")).drop("centre")


def within_set_sse(dists: DataFrame, dist: str = "dist") -> DataFrame:
    """Sum of squared distances to the assigned centres (``computeCost``)."""
    return dists.agg(F.sum(dist).alias("wssse"))


# ---- supervised (L07-L16) -----------------------------------------------------------------


def logistic_regression(features: str = "features", label: str = "label"):
    """L07 with the source's settings."""
    return LogisticRegression(maxIter=10, regParam=0.3, elasticNetParam=0.2, featuresCol=features, labelCol=label)


def linear_svc(features: str = "features", label: str = "label"):
    """L08."""
    return LinearSVC(maxIter=10, regParam=0.1, featuresCol=features, labelCol=label)


def naive_bayes(features: str = "features_raw", label: str = "label"):
    """Multinomial; needs non-negative (unscaled) features."""
    return NaiveBayes(smoothing=1.0, modelType="multinomial", featuresCol=features, labelCol=label)


def random_forest_classifier(features: str = "features", label: str = "label", seed: int = 42):
    """L10."""
    return RandomForestClassifier(
        numTrees=150, subsamplingRate=0.8, maxDepth=10, featuresCol=features, labelCol=label, seed=seed
    )


def linear_regression(features: str = "features", label: str = "label", reg: float = 0.3, elastic_net: float = 0.8, max_iter: int = 10):
    """L11 (``reg=0`` gives ordinary least squares)."""
    return LinearRegression(maxIter=max_iter, regParam=reg, elasticNetParam=elastic_net, featuresCol=features, labelCol=label)


def tree_regressors(features: str = "features", label: str = "label", seed: int = 42) -> dict:
    """L12-L14 with Spark's defaults; boosting by :class:`tessera.operators.boosting.BoostedTrees`, which fits the
    same trees as Spark's ``GBTRegressor`` and holds a row in some 20 bytes."""
    return {
        "decision_tree": DecisionTreeRegressor(featuresCol=features, labelCol=label, seed=seed),
        "random_forest": RandomForestRegressor(featuresCol=features, labelCol=label, seed=seed),
        "gbt": BoostedTrees(features, label, seed),
    }


def fit_and_score(stages: Sequence, train: DataFrame, test: DataFrame):
    """Fit a pipeline on ``train`` and return ``(model, predictions on test)``."""
    model = Pipeline(stages=list(stages)).fit(train)
    return model, model.transform(test)


def prepared(stages: Sequence, train: DataFrame, test: DataFrame, label: str = "label", features: str = "features"):
    """``(train, test)`` as written tables of features and label, the feature ``stages`` fitted on ``train``: what
    passes over the rows many times reads the features and does not make them again, and the memory is
    left to the learner's own copy of the rows."""
    made = Pipeline(stages=list(stages)).fit(train)
    return tuple(written(made.transform(side).select(features, label), what) for side, what in ((train, "train"), (test, "test")))


def class_metrics(name: str, pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(model, metric, value)`` of accuracy and weighted recall from one pass over the
    predictions: both are the share of rows whose prediction is right, recall taken per class."""
    hit = (F.col(label) == F.col(prediction)).cast("double")
    per_class = pred.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.sum(hit).alias("tp"))
    both = per_class.agg(
        F.try_divide(F.sum("tp"), F.sum("n")).alias("accuracy"),
        F.try_divide(F.sum(F.col("n") * F.col("tp") / F.col("n")), F.sum("n")).alias("weightedRecall"),
    )
    return _stacked(name, both, ["accuracy", "weightedRecall"])


def value_metrics(name: str, pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(model, metric, value)`` of RMSE and RMSLE (negative predictions as 0) from one pass."""
    both = pred.agg(
        F.sqrt(F.avg(F.pow(F.col(prediction) - F.col(label), 2))).alias("rmse"),
        F.sqrt(F.avg(squared_log_error(F.greatest(prediction, F.lit(0.0)), label))).alias("rmsle"),
    )
    return _stacked(name, both, ["rmse", "rmsle"])


def _stacked(name: str, row: DataFrame, metrics: Sequence[str]) -> DataFrame:
    pairs = ", ".join(f"'{m}', {m}" for m in metrics)
    return row.select(F.lit(name).alias("model"), F.expr(f"stack({len(metrics)}, {pairs}) as (metric, value)"))


def log_target(df: DataFrame, label: str = "label", out: str = "log_label") -> DataFrame:
    """Fit on ``log(label)`` (labels must be positive)."""
    return df.withColumn(out, F.log(label))


def exp_back(pred: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Undo :func:`log_target` on the predictions."""
    return pred.withColumn(prediction, F.exp(prediction))
