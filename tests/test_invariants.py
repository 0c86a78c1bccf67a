"""Invariants of registered queries that SQL cannot state directly."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tessera.plans.relational import HOLDOUT

SMOKE = "/root/testdata/sf0.001"


def test_standardized_columns_have_mean_zero_sd_one(spark):
    z = queries()["standardize"](spark, SMOKE)
    r = z.agg(F.avg("z_quantity"), F.stddev_samp("z_quantity"), F.avg("z_discount"), F.stddev_samp("z_discount")).first()
    assert r[0] == pytest.approx(0, abs=1e-6) and r[1] == pytest.approx(1, abs=1e-5)
    assert r[2] == pytest.approx(0, abs=1e-6) and r[3] == pytest.approx(1, abs=1e-5)


def test_one_hot_has_one_slot_or_none(spark):
    oh = queries()["one_hot_size"](spark, SMOKE)
    r = oh.agg(F.min("vec_size"), F.max("vec_size"), F.max("type_index")).first()
    assert r[0] == r[1] == r[2]  # size = categories - 1 = largest index
    dropped = oh.where(F.col("hot") == -1).select("type_index").distinct().collect()
    assert [row.type_index for row in dropped] == [r[2]]
    assert oh.where((F.col("hot") != -1) & (F.col("hot") != F.col("type_index"))).count() == 0


def test_folds_complete_disjoint_and_balanced(spark):
    folds = queries()["kfold_split"](spark, SMOKE)
    orders = spark.read.parquet(f"{SMOKE}/orders.parquet")
    assert folds.count() == orders.count() == folds.select("o_orderkey").distinct().count()
    sizes = sorted(r["count"] for r in folds.groupBy("fold").count().collect())
    assert len(sizes) == 5 and sizes[-1] - sizes[0] <= sizes[-1] // 4 + 1
    # contiguous: every fold is a key range that does not overlap another
    ranges = sorted((r[1], r[2]) for r in folds.groupBy("fold").agg(F.min("o_orderkey"), F.max("o_orderkey")).collect())
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_holdout_caps(spark):
    h = queries()["holdout_per_user"](spark, SMOKE)
    test = h.where(F.col("part") == "test")
    per_user = test.groupBy("user_id").count().agg(F.max("count")).first()[0]
    assert per_user <= HOLDOUT["stop"] - HOLDOUT["start"] + 1
    assert test.count() <= HOLDOUT["max_test"]
    assert h.count() == spark.read.parquet(f"{SMOKE}/events.parquet").count()


def test_cluster_distances_are_to_nearest_or_own_centre(spark):
    km = queries()["kmeans_assign"](spark, SMOKE)
    assert km.where(F.col("dist") < 0).count() == 0
    assert km.select("prediction").distinct().count() <= 5


def test_stream_state_equals_batch_aggregate(spark):
    state = {r.user_id: (r.n_purchases, r.revenue) for r in queries()["revenue_per_user"](spark, SMOKE).collect()}
    ev = spark.read.parquet(f"{SMOKE}/events.parquet")
    batch = {r.user_id: (r.n, round(r.s, 6)) for r in ev.groupBy("user_id").agg(F.count("*").alias("n"), F.sum("value").alias("s")).collect()}
    assert state == batch
