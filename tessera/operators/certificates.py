"""What tells that a fit is right without fitting again: sums over the rows it was fitted on, held against
the conditions that its solution meets.

Every check is one aggregate (a partial one per task), however many rows there are.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# ---- factorisation (L01) ----------------------------------------------------------------------


def half_step(ratings: DataFrame, key: str, other: str, rating: str, factors: DataFrame, rank: int, reg: float) -> DataFrame:
    """``(key, features)``: the factors of every ``key`` that solve its regularised normal equations given the
    ``factors`` (``id``, ``features``) of the other side: a half-step of ALS, and the way to give factors to
    users or items that came after the fit. The sums of outer products are one aggregate per key, made where
    the key's rows lie: a row (``rank`` numbers) is shuffled, not sums (``rank`` squared) of a few rows.
    """
    v = [F.col("_v")[i].cast("double") for i in range(rank)]
    joined = ratings.select(key, F.col(other).alias("id"), F.col(rating).cast("double").alias("_r")).join(
        factors.select("id", F.col("features").alias("_v")), "id"
    ).repartition(key)
    pairs = [(i, j) for i in range(rank) for j in range(i, rank)]
    sums = joined.groupBy(key).agg(
        F.array(*[F.sum(v[i] * v[j]) for i, j in pairs]).alias("outer"),
        F.array(*[F.sum(F.col("_r") * x) for x in v]).alias("right"),
        F.count(F.lit(1)).alias("n"),
    )

    @F.pandas_udf("array<double>")
    def solved(outer, right, n):
        import pandas as pd

        upper = np.triu_indices(rank)
        a = np.zeros((len(n), rank, rank))
        a[:, upper[0], upper[1]] = np.stack(outer.to_list()) if len(n) else 0.0
        a = a + np.triu(a, 1).transpose(0, 2, 1) if rank else a
        a += (reg * n.to_numpy())[:, None, None] * np.eye(rank)
        b = np.stack(right.to_list())[..., None] if len(n) else np.zeros((0, rank, 1))
        return pd.Series(list(np.linalg.solve(a, b)[..., 0]))

    return sums.select(key, solved("outer", "right", "n").alias("features"))


def residuals(ratings: DataFrame, key: str, other: str, rating: str, own: DataFrame, factors: DataFrame, rank: int, reg: float) -> DataFrame:
    """``(key, residual)``: how far each key's factors (``own``: ``id``, ``features``) are from solving its normal
    equations: the greatest entry of ``sum (v.u - r) v + reg n u``, over that of ``sum |r v|``."""
    arr = lambda c: F.col(c).cast("array<double>").alias(c)
    rows = ratings.select(key, F.col(other).alias("_other"), F.col(rating).cast("double").alias("_r"))
    rows = rows.join(factors.select(F.col("id").alias("_other"), F.col("features").alias("_v")), "_other")
    rows = rows.join(own.select(F.col("id").alias(key), F.col("features").alias("_u")), key).select(key, "_r", arr("_v"), arr("_u"))
    dot = sum((F.col("_v")[i] * F.col("_u")[i] for i in range(rank)), F.lit(0.0))
    rows = rows.select(key, "_v", "_u", "_r", (dot - F.col("_r")).alias("_e"))
    sums = rows.groupBy(key).agg(
        *[F.sum(F.col("_e") * F.col("_v")[i]).alias(f"g{i}") for i in range(rank)],
        *[F.sum(F.abs(F.col("_r") * F.col("_v")[i])).alias(f"s{i}") for i in range(rank)],
        F.first("_u").alias("_u"), F.count(F.lit(1)).alias("_n"),
    )
    off = [F.abs(F.col(f"g{i}") + reg * F.col("_n") * F.col("_u")[i]) for i in range(rank)]
    size = [F.col(f"s{i}") for i in range(rank)]
    both = [F.greatest(*c) if rank > 1 else c[0] for c in (off, size)]
    return sums.select(key, F.try_divide(both[0], both[1]).alias("residual"))


# ---- logistic regression (L07) ----------------------------------------------------------------


def logistic_gradient(
    rows: DataFrame, features: str, label: str, weights: Sequence[float], intercept: float, reg: float, elastic_net: float
) -> DataFrame:
    """``(weight, value, gradient, off)``: for the intercept (weight -1) and every weight, the gradient of the mean
    logistic loss with its l2 penalty, and how far it is from what an optimum has: 0 for the intercept;
    minus the l1 penalty's slope where the weight is not 0, within it where it is.

    ``features``: an array column of scaled features, on which Spark's penalty applies to the weights as
    they are; ``weights``: as many.
    """
    d = len(weights)
    x = [F.col(features)[i] for i in range(d)]
    margin = sum((F.lit(float(w)) * c for w, c in zip(weights, x, strict=True)), F.lit(float(intercept)))
    wrong = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)) - F.col(label)
    sums = rows.select(features, wrong.alias("_wrong")).agg(
        F.array(F.avg("_wrong"), *[F.avg(F.col("_wrong") * c) for c in x]).alias("g")
    )
    l1, l2 = reg * elastic_net, reg * (1 - elastic_net)
    values = F.array(F.lit(0.0), *[F.lit(float(w)) for w in weights])
    one = sums.select(F.posexplode(F.arrays_zip("g", values.alias("w"))).alias("i", "z"))
    g = F.col("z.g") + l2 * F.col("z.w")
    off = F.when(F.col("i") == 0, F.abs(g)).when(F.col("z.w") != 0, F.abs(g + l1 * F.signum("z.w"))).otherwise(F.greatest(F.abs(g) - l1, F.lit(0.0)))
    return one.select((F.col("i") - 1).alias("weight"), F.col("z.w").alias("value"), g.alias("gradient"), off.alias("off"))


# ---- linear SVM (L08) -------------------------------------------------------------------------


def hinge_steps(
    rows: DataFrame, features: str, label: str, weights: Sequence[float], intercept: float, reg: float, step: float = 0.01
) -> DataFrame:
    """``(weight, lowered)``: by how much the mean hinge loss with its l2 penalty falls when the intercept (weight
    -1) or one weight moves by ``step``, the better of both directions; at an optimum none does. The
    losses of all steps are one aggregate. ``features``: as in :func:`logistic_gradient`."""
    d = len(weights)
    x = [F.lit(1.0), *[F.col(features)[i] for i in range(d)]]
    w = [float(intercept), *map(float, weights)]
    sign = 2 * F.col(label) - 1
    margin = sum((F.lit(a) * c for a, c in zip(w, x, strict=True)), F.lit(0.0))
    loss = lambda m: F.avg(F.greatest(F.lit(0.0), 1 - sign * m))
    penalty = lambda values: reg / 2 * sum(v * v for v in values[1:])
    held = rows.select(features, label, margin.alias("_m"))
    losses = [(loss(F.col("_m")) + penalty(w)).alias("l")]
    for i in range(d + 1):
        for by in (step, -step):
            moved = [*w[:i], w[i] + by, *w[i + 1 :]]
            losses.append((loss(F.col("_m") + by * x[i]) + penalty(moved)).alias("l"))
    sums = held.agg(F.array(*losses).alias("l"))
    pairs = F.transform(F.sequence(F.lit(0), F.lit(d)), lambda i: F.col("l")[0] - F.least(F.col("l")[2 * i + 1], F.col("l")[2 * i + 2]))
    return sums.select(F.posexplode(pairs).alias("i", "lowered")).select((F.col("i") - 1).alias("weight"), "lowered")


# ---- naive Bayes (L09) ------------------------------------------------------------------------


def bayes_predictions(
    train: DataFrame, rows: DataFrame, label: str, numbers: Sequence[str], category: str, keys: Sequence[str], smoothing: float = 1.0
) -> DataFrame:
    """``(*keys, prediction)``: multinomial naive Bayes from sums. Features are the non-negative ``numbers`` and
    one for each ``category`` of the train side; a row of another category has none of them.

    The model is two aggregates: a row for each class (folded into one array that every task holds) and
    the rows of each category by class, joined to ``rows`` by category.
    """
    sums = train.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.array(*[F.sum(c) for c in numbers]).alias("sums"))
    n_categories = train.agg(F.countDistinct(category)).scalar()
    every, classes = (sums.agg(a).scalar() for a in (F.sum("n"), F.count(F.lit(1))))
    size = smoothing * (n_categories + len(numbers))
    total = F.col("n") + F.aggregate("sums", F.lit(0.0), lambda a, v: a + v) + size
    model = sums.select(
        F.col(label).alias("c"), F.log(total).alias("log_total"),
        (F.log(F.col("n") + smoothing) - F.log(every + smoothing * classes)).alias("prior"), "sums",
    )
    folded = model.agg(F.sort_array(F.collect_list(F.struct("c", "log_total", "prior", "sums"))).alias("m")).scalar()
    counts = train.groupBy(category, label).agg(F.count(F.lit(1)).alias("s"))
    by_category = counts.groupBy(category).agg(F.collect_list(F.struct(F.col(label).alias("c"), "s")).alias("_counts"))  # by class
    held = rows.select(*keys, category, F.array(*[F.col(c).cast("double") for c in numbers]).alias("_x"))
    held = held.join(by_category, category, "left").withColumn("_model", folded)

    def score(m):
        logs = F.zip_with("_x", m["sums"], lambda x, s: x * (F.log(s + smoothing) - m["log_total"]))
        own = F.aggregate(F.filter("_counts", lambda z: z["c"] == m["c"]), F.lit(0).cast("long"), lambda a, z: a + z["s"])
        known = F.when(F.col("_counts").isNotNull(), F.log(own + smoothing) - m["log_total"]).otherwise(0.0)
        return m["prior"] + F.aggregate(logs, F.lit(0.0), lambda a, v: a + v) + known

    scored = F.transform("_model", lambda m: F.struct((-score(m)).alias("far"), m["c"].alias("c")))
    return held.select(*keys, F.array_min(scored)["c"].alias("prediction"))


# ---- regression trees (L12-L14) ---------------------------------------------------------------


def cut_gains(rows: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """``(feature, cut, gain, left_mean, right_mean)``: for every cut between two values that a feature takes, how
    much it lowers the variance of ``label`` and the means on both sides (up to the cut: left).

    The sums per feature and value are one aggregate; what follows runs on a row per value, so features
    of very many values are to be binned first.
    """
    y = F.col(label).cast("double")
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in features]))
    one = rows.select(pairs.alias("p"), y.alias("y")).groupBy("p.feature", "p.x").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"), F.sum(F.col("y") * F.col("y")).alias("q")
    )
    whole = Window.partitionBy("feature")
    upto = whole.orderBy("x")
    left = {c: F.sum(c).over(upto) for c in ("n", "s", "q")}
    every = {c: F.sum(c).over(whole) for c in ("n", "s", "q")}
    cuts = one.select(
        "feature", ((F.col("x") + F.lead("x").over(upto)) / 2).alias("cut"),
        *[left[c].alias(f"l{c}") for c in left], *[every[c].alias(f"a{c}") for c in every],
    ).where("cut is not null")
    spread = lambda n, s, q: q - s * s / n
    l_, a = (tuple(F.col(p + c) for c in ("n", "s", "q")) for p in "la")
    r = tuple(x - z for x, z in zip(a, l_, strict=True))
    gain = (spread(*a) - spread(*l_) - spread(*r)) / a[0]
    return cuts.select("feature", "cut", gain.alias("gain"), (l_[1] / l_[0]).alias("left_mean"), (r[1] / r[0]).alias("right_mean"))


def gini_gains(rows: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """As :func:`cut_gains` for a ``label`` of 0 and 1: how much each cut lowers the Gini impurity (twice the
    variance of such a label)."""
    return cut_gains(rows, features, label).withColumn("gain", 2 * F.col("gain"))


def best_cut(gains: DataFrame) -> DataFrame:
    """The row of :func:`cut_gains` with the greatest gain."""
    return gains.orderBy(F.desc("gain"), "feature", "cut").limit(1)
