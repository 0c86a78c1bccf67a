"""Boosted trees from histograms: the same model as Spark's learner, and how little is moved for it."""

import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tessera.operators import boosting, models


def _rows(spark, n=3000, parts=3):
    pick = random.Random(5)
    rows = []
    for i in range(n):
        c, x, z = pick.randrange(9), round(pick.gauss(0, 3), 2), float(pick.randrange(4))  # more values of x than bins, and zeros
        rows.append((i, f"c{c}", x if pick.random() < 0.8 else 0.0, z, 10.0 * (c in (1, 4, 7)) + x * x - z * x + pick.gauss(0, 1)))
    return spark.createDataFrame(rows, "id long, c string, x double, z double, label double").repartition(parts, "id")


@pytest.fixture(scope="module")
def made(spark):
    """Features as the queries make them: categories as numbers and one-hot."""
    out = []
    for stages in (
        [StringIndexer(inputCol="c", outputCol="i"), VectorAssembler(inputCols=["i", "x", "z"], outputCol="features")],
        [StringIndexer(inputCol="c", outputCol="i"), OneHotEncoder(inputCols=["i"], outputCols=["v"]), VectorAssembler(inputCols=["v", "x", "z"], outputCol="features")],
    ):
        df = _rows(spark)
        out.append(Pipeline(stages=stages).fit(df).transform(df).select("id", "features", "label").localCheckpoint())
    return out


@pytest.mark.parametrize("kind", [0, 1])
@pytest.mark.parametrize("sample", [10_000, 500])
def test_same_model_as_spark_s(spark, made, monkeypatch, kind, sample):
    monkeypatch.setattr(boosting, "SPLIT_ROWS", sample)
    ours = boosting.BoostedTrees(trees=4, small=0).fit(made[kind]).transform(made[kind]).withColumnRenamed("prediction", "ours")
    both = GBTRegressor(featuresCol="features", labelCol="label", seed=42, maxIter=4).fit(made[kind]).transform(ours)
    if sample == 10_000:
        assert both.agg(F.max(F.abs(F.col("ours") - F.col("prediction")))).first()[0] < 1e-8
    else:  # other splits of x, as good
        wrong = both.agg(F.avg(F.pow(F.col("ours") - F.col("label"), 2)), F.avg(F.pow(F.col("prediction") - F.col("label"), 2))).first()
        assert wrong[0] < 1.5 * wrong[1]


def test_the_regressors_boost_large_tables_by_chunks(made):
    est = models.tree_regressors()["gbt"]
    assert type(est) is boosting.BoostedTrees and est.trees == 20
    assert not isinstance(est.fit(made[0].limit(20)), boosting.BoostedTreesModel)
    est.small, est.trees = 19, 1
    assert isinstance(est.fit(made[0].limit(20)), boosting.BoostedTreesModel)


def test_the_learner_holds_few_bytes_a_row(spark, made):
    est = models.tree_regressors()["gbt"]
    bins = est._bins(made[1].select("features", F.col("label").alias("y")), made[1].count())
    rows = made[1].select(boosting.vector_to_array("features").alias("x"), F.col("label").alias("y"))
    held = rows.mapInArrow(boosting._binned(bins), boosting._CHUNKS)
    bytes_, chunks = held.agg(F.sum(F.length("codes") + F.length("rest")), F.count(F.lit(1))).first()
    assert bytes_ == made[1].count() * (8 + 2 * len(bins.groups)) and chunks <= 3  # Spark's object for such a row takes over 100
    assert len(bins.groups) < len(bins.count) and max(bins.size) <= boosting.JOINT


def test_thresholds_by_force():
    assert boosting.thresholds([], 5, 31).tolist() == []
    assert boosting.thresholds([(2.0, 5)], 5, 31).tolist() == []  # constant
    assert boosting.thresholds([(2.0, 3), (-2.0, 1)], 6, 31).tolist() == [-1.0, 1.0]  # two zeros
    assert boosting.thresholds([(float(v), 1) for v in range(1, 9)], 8, 3).tolist() == [2.5, 4.5, 6.5]


def test_odd_tables(spark):
    def table(rows):
        df = spark.createDataFrame(rows, "x double, label double")
        return VectorAssembler(inputCols=["x"], outputCol="features", handleInvalid="keep").transform(df)

    est = boosting.BoostedTrees(trees=3, small=0)
    for rows in ([(1.0, 2.0)], [(1.0, 2.0)] * 50, [(float(i), 7.0) for i in range(50)]):
        got = {r.prediction for r in est.fit(table(rows)).transform(table(rows)).collect()}
        assert len(got) == 1 and got.pop() == pytest.approx(rows[0][1])
    for rows in ([(1.0, None), (2.0, 1.0)], [(1.0, float("nan")), (2.0, 1.0)], [(None, 1.0), (2.0, 1.0)]):
        with pytest.raises(Exception, match="null, NaN|NaN or infinite"):
            est.fit(table(rows))
    with pytest.raises(Exception):  # noqa: B017 - Spark's own
        est.fit(table([(1.0, 1.0)]).where("x > 1"))


def _boosted_in(spark, query, monkeypatch):
    seen = []

    def recorded(stages, train, test):
        seen.append(stages[-1])
        return None, test.withColumn("prediction", F.lit(1.0))

    monkeypatch.setattr(models, "fit_and_score", recorded)
    query(spark, "/root/testdata/sf0.001")
    return [type(est) is boosting.BoostedTrees for est in seen]


def test_regressor_invariants_boosts_by_chunks(spark, monkeypatch):
    from tessera.plans import invariants

    assert sum(_boosted_in(spark, invariants.regressor_invariants, monkeypatch)) == 1


def test_regression_compare_boosts_by_chunks(spark, monkeypatch):
    from tessera.plans import models as plans

    assert sum(_boosted_in(spark, plans.regression_compare, monkeypatch)) == 1
