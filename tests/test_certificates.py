"""Checks of fits against numpy: normal equations, gradients, losses, class sums, cuts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import certificates as c


def _ratings(spark, seed=2, users=12, items=9):
    rng = np.random.default_rng(seed)
    rows = [(u, i, float(rng.integers(1, 6))) for u in range(users) for i in range(items) if rng.random() < 0.6]
    factors = rng.normal(size=(items, 3))
    table = spark.createDataFrame(rows, "u int, i int, rating double")
    return table, rows, spark.createDataFrame([(k, [float(x) for x in f]) for k, f in enumerate(factors)], "id int, features array<float>"), factors


def test_half_step_solves_the_normal_equations(spark):
    table, rows, frame, factors = _ratings(spark)
    factors = factors.astype(np.float32).astype(float)
    got = {r.u: r.features for r in c.half_step(table.repartition(3), "u", "i", "rating", frame, 3, 0.1).collect()}
    for u, own in got.items():
        mine = [(i, r) for w, i, r in rows if w == u]
        v, r = factors[[i for i, _ in mine]], np.array([r for _, r in mine])
        assert own == pytest.approx(np.linalg.solve(v.T @ v + 0.1 * len(r) * np.eye(3), v.T @ r))
    solved = spark.createDataFrame([(u, f) for u, f in got.items()], "id int, features array<double>")
    off = {r.u: r.residual for r in c.residuals(table, "u", "i", "rating", solved, frame, 3, 0.1).collect()}
    assert set(off) == set(got) and max(off.values()) < 1e-9
    bent = solved.withColumn("features", F.transform("features", lambda x: x * 1.05))
    assert min(r.residual for r in c.residuals(table, "u", "i", "rating", bent, frame, 3, 0.1).collect()) > 1e-4
    assert c.half_step(table.limit(0), "u", "i", "rating", frame, 3, 0.1).count() == 0


def _classes(spark, n=300):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(n, 2))
    y = (x[:, 0] + rng.normal(size=n) > 0).astype(float)
    return spark.createDataFrame([([float(v) for v in a], float(b)) for a, b in zip(x, y, strict=True)], "xs array<double>, label double"), x, y


def test_logistic_gradient_equals_numpy(spark):
    df, x, y = _classes(spark)
    w, b = np.array([0.7, 0.0]), -0.2
    wrong = 1 / (1 + np.exp(-(x @ w + b))) - y
    got = {r.weight: (r.gradient, r.off) for r in c.logistic_gradient(df.repartition(4), "xs", "label", w, b, 0.3, 0.2).collect()}
    g = x.T @ wrong / len(y) + 0.3 * 0.8 * w
    assert got[-1] == (pytest.approx(wrong.mean()), pytest.approx(abs(wrong.mean())))
    assert got[0] == (pytest.approx(g[0]), pytest.approx(abs(g[0] + 0.06)))
    assert got[1] == (pytest.approx(g[1]), pytest.approx(max(abs(g[1]) - 0.06, 0.0)))


def test_hinge_steps_equal_numpy(spark):
    df, x, y = _classes(spark)
    loss = lambda w, b: np.maximum(0, 1 - (2 * y - 1) * (x @ w + b)).mean() + 0.05 * w @ w
    w, b = np.array([0.5, 0.1]), 0.3
    got = {r.weight: r.lowered for r in c.hinge_steps(df.repartition(4), "xs", "label", w, b, 0.1, 0.02).collect()}
    assert got[-1] == pytest.approx(loss(w, b) - min(loss(w, b + 0.02), loss(w, b - 0.02)))
    for i, e in enumerate(np.eye(2) * 0.02):
        assert got[i] == pytest.approx(loss(w, b) - min(loss(w + e, b), loss(w - e, b)))


def test_bayes_by_force(spark):
    rng = np.random.default_rng(5)
    rows = [(k, float(rng.integers(0, 2)), float(rng.integers(0, 9)), float(rng.integers(0, 5)), "abcd"[rng.integers(0, 4)]) for k in range(80)]
    kind = "id long, label double, p double, q double, kind string"
    train, test = spark.createDataFrame(rows[:60], kind), spark.createDataFrame([*rows[60:], (99, 0.0, 2.0, 1.0, "new"), (100, 0.0, 2.0, 1.0, None)], kind)
    got = {r.id: r.prediction for r in c.bayes_predictions(train, test, "label", ["p", "q"], "kind", ["id"]).collect()}
    kinds = sorted({r[4] for r in rows[:60]})
    for i, _, p, q, kind_ in [*rows[60:], (99, 0, 2.0, 1.0, "new"), (100, 0, 2.0, 1.0, None)]:
        scores = {}
        for label in (0.0, 1.0):
            own = [r for r in rows[:60] if r[1] == label]
            sums = np.array([sum(r[2] for r in own), sum(r[3] for r in own), *[sum(r[4] == k for r in own) for k in kinds]]) + 1
            x = np.array([p, q, *[kind_ == k for k in kinds]], float)
            scores[label] = np.log((len(own) + 1) / 62) + x @ np.log(sums / sums.sum())
        assert got[i] == max(scores, key=lambda k: (scores[k], -k)), i


def test_cuts_by_force(spark):
    rng = np.random.default_rng(6)
    x, z = rng.integers(0, 6, 200).astype(float), rng.integers(0, 3, 200).astype(float)
    y = x * 2 + (z > 1) * 5 + rng.normal(size=200)
    df = spark.createDataFrame([(float(a), float(b), float(d)) for a, b, d in zip(x, z, y, strict=True)], "x double, z double, y double")
    got = {(r.feature, r.cut): r for r in c.cut_gains(df.repartition(3), ["x", "z"], "y").collect()}
    for name, v in (("x", x), ("z", z)):
        values = np.unique(v)
        for cut in (values[1:] + values[:-1]) / 2:
            r, left = got.pop((name, cut)), v <= cut
            assert r.gain == pytest.approx(y.var() - left.mean() * y[left].var() - (~left).mean() * y[~left].var())
            assert (r.left_mean, r.right_mean) == (pytest.approx(y[left].mean()), pytest.approx(y[~left].mean()))
    assert not got
    best = c.best_cut(c.cut_gains(df, ["x", "z"], "y")).first()
    assert best.feature == "x"


def test_half_step_shuffles_rows_not_sums(spark):
    table, _, frame, _ = _ratings(spark)
    plan = c.half_step(table, "u", "i", "rating", frame, 3, 0.1)._jdf.queryExecution().executedPlan().toString()
    above = plan.split("Exchange hashpartitioning(u#")[0]
    assert above.count("HashAggregate") + above.count("ObjectHashAggregate") >= 2  # partial and final, after the shuffle
