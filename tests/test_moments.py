"""Moments: sums that add up, fits that equal those over the samples."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tessera.operators import models
from tessera.operators.moments import added, fit, moments


def _samples(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(5, 2, (n, 3))
    x[:, 2] = 7.0  # without variance
    y = 3 + 2 * x[:, 0] - 0.2 * x[:, 1] + rng.normal(0, 1, n)
    return spark.createDataFrame([(float(b), [float(v) for v in a]) for a, b in zip(x, y, strict=True)], "label double, xs array<double>"), x, y


def test_moments_are_sums_of_products(spark):
    df, x, y = _samples(spark)
    z = np.column_stack([np.ones(len(y)), x, y])
    want = z.T @ z
    got = {(r.i, r.j): r.value for r in moments(df.repartition(5)).collect()}
    assert len(got) == 15 and all(got[i, j] == pytest.approx(want[i, j]) for i, j in got)


def test_parts_add_up(spark):
    df, *_ = _samples(spark)
    low, high = df.where("label < 12"), df.where("label >= 12")
    whole, parts = fit(moments(df)), fit(added(moments(low), moments(high)))
    assert whole.samples == parts.samples == 400
    assert [whole.intercept, whole.rmse, *whole.coefficients] == pytest.approx([parts.intercept, parts.rmse, *parts.coefficients])


def test_least_squares_equals_numpy(spark):
    df, x, y = _samples(spark)
    got = fit(moments(df))
    beta, *_ = np.linalg.lstsq(np.column_stack([np.ones(len(y)), x[:, :2]]), y, rcond=None)
    assert [got.intercept, *got.coefficients] == pytest.approx([*beta, 0.0])
    assert got.rmse == pytest.approx(np.sqrt(np.mean((y - beta[0] - x[:, :2] @ beta[1:]) ** 2)))


@pytest.mark.parametrize(("reg", "share"), [(0.3, 0.8), (0.5, 0.0), (0.2, 1.0), (5.0, 1.0)])
def test_penalised_fit_equals_spark_ml(spark, reg, share):
    df, *_ = _samples(spark)
    ml = models.linear_regression(reg=reg, elastic_net=share, max_iter=500).setTol(1e-12).fit(df.select("label", array_to_vector("xs").alias("features")))
    got = fit(moments(df), reg, share)
    assert [got.intercept, *got.coefficients] == pytest.approx([ml.intercept, *ml.coefficients], abs=1e-5)
    assert got.rmse == pytest.approx(ml.summary.rootMeanSquaredError, rel=1e-6)


def test_no_samples_and_constant_label(spark):
    empty = spark.createDataFrame([], "label double, xs array<double>")
    assert fit(moments(empty)) == (0, [], None, None)
    same = spark.createDataFrame([(2.0, [1.0]), (2.0, [3.0])], empty.schema)
    got = fit(moments(same.select(F.col("label"), "xs")))
    assert got.coefficients == [0.0] and got.intercept == 2.0 and got.rmse == pytest.approx(0.0, abs=1e-7)
