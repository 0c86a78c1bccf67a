"""Model invariants: nearest centres, costs, metrics equal to the ML evaluators."""

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from tessera.operators import clusters, models
from tessera.plans import models as model_plans

SMOKE = "/root/testdata/sf0.001"


def test_kmeans_assigns_nearest_centre_and_cost(spark):
    e = model_plans._embeddings(spark, SMOKE)
    model = models.kmeans(e, k=5, seed=1, features="features", prediction="cluster")
    centres = models.centre_table(model, spark)
    assigned = model.transform(e).select("vec_id", "arr", F.col("cluster").alias("prediction"))
    own = models.distance_to_centre(assigned, centres, "arr", out="own")
    # brute force: distance to every one of the k centres, held as a literal array
    lit_centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()])
    sq = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
    best = own.withColumn("_c", lit_centres).select(
        "vec_id", "own", F.array_min(F.transform("_c", lambda c: sq(F.col("arr"), c))).alias("best")
    )
    worst_gap = best.agg(F.max(F.col("own") - F.col("best"))).first()[0]
    assert worst_gap <= 1e-9
    cost = models.within_set_sse(own, "own").first()[0]
    assert cost == pytest.approx(model.summary.trainingCost, rel=1e-6)


def test_group_centres_are_means(spark):
    df = spark.createDataFrame([(0, 1, [1.0, 2.0]), (1, 1, [3.0, 4.0]), (2, 2, [5.0, 5.0])], "k int, g int, a array<double>")
    c = {r.g: r.centre for r in clusters.group_centres(df, "g", "a").collect()}
    assert c == {1: [2.0, 3.0], 2: [5.0, 5.0]}
    ex = clusters.explain_clusters(df, "g", "k", "a", 1).orderBy("g").collect()
    assert [(r.g, r.dist, r.cluster_size) for r in ex] == [(1, 2.0, 2), (2, 0.0, 1)]


def test_metrics_equal_evaluators(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 1.0), (1.0, 1.0), (2.0, 0.0)], "label double, prediction double")
    assert models.accuracy(df).first()[0] == pytest.approx(MulticlassClassificationEvaluator(metricName="accuracy").evaluate(df))
    assert models.weighted_recall(df).first()[0] == pytest.approx(
        MulticlassClassificationEvaluator(metricName="weightedRecall").evaluate(df)
    )
    assert models.rmse(df).first()[0] == pytest.approx(RegressionEvaluator(metricName="rmse").evaluate(df))


def test_least_squares_matches_closed_form(spark):
    rows = model_plans.linreg_simple(spark, SMOKE).first()
    li = spark.read.parquet(f"{SMOKE}/lineitem.parquet")
    ref = li.agg(F.regr_slope("l_extendedprice", "l_quantity").alias("b"), F.regr_intercept("l_extendedprice", "l_quantity").alias("a")).first()
    assert rows.slope == pytest.approx(ref.b, abs=1e-3) and rows.intercept == pytest.approx(ref.a, abs=1e-3)


def test_als_factor_means(spark):
    out = model_plans.als_factors(spark, SMOKE)
    kinds = {r.kind: r.n for r in out.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    ratings = model_plans.ratings(spark, SMOKE)
    assert kinds["user"] == ratings.select("user").distinct().count()
    assert kinds["item"] == ratings.select("item").distinct().count()
    lo, hi = ratings.agg(F.min("rating"), F.max("rating")).first()
    assert 1.0 <= lo <= hi <= 5.0


def test_blocks_of_als_grow_with_the_ratings(spark, monkeypatch):
    table = spark.createDataFrame([(u, i, float(1 + (u + i) % 5)) for u in range(8) for i in range(8)], "u int, i int, rating float")
    parts = lambda m: (m.userFactors.rdd.getNumPartitions(), m.itemFactors.rdd.getNumPartitions())
    few = models.als(table, "u", "i", "rating", rank=2, max_iter=1, blocks=3)
    monkeypatch.setattr(models, "BLOCK_ROWS", 10)
    many = models.als(table, "u", "i", "rating", rank=2, max_iter=1, blocks=3)
    assert parts(few) == (3, 3) and parts(many) == (7, 7)
    assert few.userFactors.count() == many.userFactors.count() == 8


def test_naive_bayes_gets_non_negative_features(spark):
    out = model_plans.naive_bayes(spark, SMOKE).collect()
    assert {r.metric for r in out} == {"accuracy", "weightedRecall"}
    assert all(0.0 <= r.value <= 1.0 for r in out)


def test_ratings_are_made_once(spark):
    from __spark_entry__ import queries

    for name in ("ratings_per_user", "als_solves", "als_factors"):
        plan = queries()[name](spark, SMOKE)._jdf.queryExecution().toString()
        assert "l_orderkey" not in plan  # what follows reads the written ratings


def test_tree_fits_read_features_made_once(spark, monkeypatch):
    from tessera.plans import invariants

    seen = []

    def recorded(stages, train, test):
        seen.append((type(stages[-1]).__name__, len(stages), train, test))
        return None, test.withColumn("prediction", F.lit(1.0))

    monkeypatch.setattr(models, "fit_and_score", recorded)
    for query in (model_plans.rforest, model_plans.gbt, model_plans.regression_compare, invariants.regressor_invariants):
        query(spark, SMOKE)
    assert len(seen) == 2 + 2 + 5 + 4
    for name, stages, train, test in seen:
        assert not any("lineitem" in f for f in train.inputFiles() + test.inputFiles())  # the split is not drawn again
        if name != "LinearRegression":
            assert stages == 1 and train.columns == ["features", "label"]
            attrs = train.schema["features"].metadata["ml_attr"]["attrs"]
            assert len(attrs.get("nominal", [])) == 5 or len(attrs["binary"]) > 5  # still categories to the trees


def test_prepared_features_give_the_same_trees(spark):
    rows = [(f"c{i % 7}", float(i % 5), float((i * 37) % 11 + 10 * (i % 7 in (1, 4)))) for i in range(200)]
    df = spark.createDataFrame(rows, "c string, x double, label double").coalesce(1)
    stages = [StringIndexer(inputCol="c", outputCol="i"), VectorAssembler(inputCols=["i", "x"], outputCol="features")]
    made = models.prepared(stages, df, df)
    for est in models.tree_regressors().values():
        _, old = models.fit_and_score([*stages, est], df, df)
        _, new = models.fit_and_score([est], *made)
        count = lambda p: sorted(p.groupBy("label", "prediction").count().collect())
        assert count(old) == count(new)
