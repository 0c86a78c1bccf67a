"""Gradient-boosted regression trees (L14) for tables of many rows: the fit of Spark's ``GBTRegressor`` with its
defaults, made from histograms.

What grows trees sees a row by its bins and its residual only. A row is binned once and then takes 8 bytes for the
residual and 2 for every group of features, in chunks of many rows; a pass over all rows adds up, for each node of
a level, how many rows and how much of the residual fall to every bin. That is the learner's own algorithm, with
its splits, its order of candidates and its leaves, without an object for each row: per pass and task one table of
sums is shuffled, and no more than the nodes of a level times the bins reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Spark's defaults.
TREES, DEPTH, BINS, STEP, SPLIT_ROWS = 20, 5, 32, 0.1, 10_000
#: Rows of a chunk, and the greatest number of bins that a group of features has together.
CHUNK, JOINT = 32_768, 512
_CHUNKS, _SUMS = "codes binary, rest binary", "sums binary"


def category_counts(df: DataFrame, features: str) -> tuple[int, dict[int, int]]:
    """How many features the vector column has, and the number of values of those that are categories."""
    meta = df.schema[features].metadata.get("ml_attr", {})
    attrs = meta.get("attrs", {})
    arity = {a["idx"]: 2 for a in attrs.get("binary", [])}
    arity |= {a["idx"]: len(a["vals"]) if "vals" in a else a["num_vals"] for a in attrs.get("nominal", [])}
    n = meta.get("num_attrs") or sum(map(len, attrs.values())) or df.select(F.size(vector_to_array(features))).first()[0]
    return n, arity


def thresholds(values: Sequence[tuple[float, int]], expected: float, splits: int) -> np.ndarray:
    """Where a number is cut into bins, from ``(value, count)`` of the values other than 0 in a sample of ``expected``
    rows: between all values, or where the counts come nearest to equal shares."""
    if not values:
        return np.zeros(0)
    seen = sum(c for _, c in values)
    if expected - seen > 2.220446049250313e-16 * seen * 100:
        values = [(0.0, expected - seen), *values]
    x, w = map(np.asarray, zip(*sorted(values), strict=True))
    between = (x[:-1] + x[1:]) / 2
    if len(between) <= splits:
        return between
    share = expected / (splits + 1)
    out, upto, target = [], w[0], share
    for i in range(1, len(x)):
        before, upto = upto, upto + w[i]
        if abs(before - target) < abs(upto - target):
            out.append(between[i - 1])
            target += share
    return np.array(out)


def _sampled(df: DataFrame, share: float, seed: int) -> DataFrame:
    """The rows that Spark's learner draws to place its splits."""
    spark = df.sparkSession
    drawn = spark.sparkContext._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
    rows = df._jdf.toJavaRDD().sample(False, share, drawn)
    return DataFrame(spark._jsparkSession.createDataFrame(rows, df._jdf.schema()), spark)


class Bins:
    """The bins of every feature and the groups of features whose bins are counted together."""

    def __init__(self, size: int, arity: dict[int, int], cuts: dict[int, np.ndarray]):
        self.arity, self.cuts = arity, cuts
        self.count = [arity[f] if f in arity else len(cuts[f]) + 1 for f in range(size)]
        self.groups: list[list[int]] = []
        room = 0
        for f, n in enumerate(self.count):
            if not self.groups or room * n > JOINT:
                self.groups.append([])
                room = 1
            self.groups[-1].append(f)
            room *= n
        self.size = [int(np.prod([self.count[f] for f in g])) for g in self.groups]

    def of(self, x: np.ndarray) -> np.ndarray:
        """A code for each group (first axis) and row of the matrix ``x``."""
        if not np.isfinite(x).all():
            raise ValueError("features must not be NaN or infinite")
        out = np.zeros((len(self.groups), len(x)), np.uint16)
        for code, group in zip(out, self.groups, strict=True):
            for f in group:
                b = x[:, f].astype(np.int64) if f in self.arity else np.searchsorted(self.cuts[f], x[:, f])
                if len(b) and not (0 <= b.min() and b.max() < self.count[f]):
                    raise ValueError(f"feature {f} has values that are none of its {self.count[f]} categories")
                code[:] = code * self.count[f] + b
        return out

    def by_feature(self, sums: list[np.ndarray], nodes: int) -> np.ndarray:
        """Counts and sums for each node and bin of every feature, one after the other, of those by group."""
        out = []
        for group, table in zip(self.groups, sums, strict=True):
            table = table.reshape(2, nodes, *[self.count[f] for f in group])
            out += [table.sum(axis=tuple(2 + j for j in range(len(group)) if j != k)).ravel() for k in range(len(group))]
        return np.concatenate(out)

    def tables(self, sums: np.ndarray, nodes: int) -> list[np.ndarray]:
        """Of every feature ``(2, nodes, bins)`` from :meth:`by_feature`'s row."""
        ends = np.cumsum([2 * nodes * n for n in self.count])
        return [t.reshape(2, nodes, -1) for t in np.split(sums, ends[:-1])]

    def turns(self, node: int, nodes: int, f: int, right: np.ndarray, level: dict[int, np.ndarray]) -> None:
        """Enters into ``level`` that ``node`` sends the bins of ``f`` that are ``right`` that way."""
        g = next(k for k, group in enumerate(self.groups) if f in group)
        table = level.setdefault(g, np.zeros((nodes, self.size[g]), np.uint8))
        shape = [self.count[x] if x == f else 1 for x in self.groups[g]]
        table[node] = np.broadcast_to(right.reshape(shape), [self.count[x] for x in self.groups[g]]).ravel()


def _node_of(codes: np.ndarray, levels: list[dict[int, np.ndarray]]) -> np.ndarray:
    """The node of each row below ``levels``; a node that is not split sends its rows to the left."""
    at = np.zeros(codes.shape[1], np.int64)
    for level in levels:
        right = np.zeros(len(at), np.int64)
        for g, table in level.items():
            right += table.ravel()[at * table.shape[1] + codes[g]]
        at = 2 * at + right
    return at


def _chunks(batches, groups: int):
    for batch in batches:
        for codes, rest in zip(batch["codes"], batch["rest"], strict=True):
            yield np.frombuffer(codes.as_buffer(), np.uint16).reshape(groups, -1), np.frombuffer(rest.as_buffer(), np.float64)


def _chunk_batch(codes: np.ndarray, rest: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([codes.tobytes()], pa.binary()), pa.array([rest.tobytes()], pa.binary())], ["codes", "rest"])


def _binned(bins: Bins):
    def run(batches):
        for batch in batches:
            y = batch["y"].to_numpy(zero_copy_only=False).astype(np.float64)
            if batch["y"].null_count or batch["x"].null_count or not np.isfinite(y).all():
                raise ValueError("labels and features must not be null, NaN or infinite")
            x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
            for low in range(0, len(y), CHUNK):
                yield _chunk_batch(bins.of(x[low : low + CHUNK]), y[low : low + CHUNK])

    return run


def _without(groups: int, levels, leaves: np.ndarray):
    """The rows' residuals after a tree."""

    def run(batches):
        for codes, rest in _chunks(batches, groups):
            yield _chunk_batch(codes, rest - leaves[_node_of(codes, levels)])

    return run


def _level_sums(bins: Bins, levels):
    def run(batches):
        nodes = 1 << len(levels)
        sums = [np.zeros((2, nodes * n)) for n in bins.size]
        for codes, rest in _chunks(batches, len(sums)):
            at = _node_of(codes, levels)
            for own, code, n in zip(sums, codes, bins.size, strict=True):
                place = at * n + code
                own[0] += np.bincount(place, minlength=nodes * n)
                own[1] += np.bincount(place, rest, minlength=nodes * n)
        yield pa.RecordBatch.from_arrays([pa.array([bins.by_feature(sums, nodes).tobytes()], pa.binary())], ["sums"])

    return run


def _added(batches):
    total = None
    for batch in batches:
        for row in batch["sums"]:
            one = np.frombuffer(row.as_buffer(), np.float64)
            total = one.copy() if total is None else np.add(total, one, out=total)
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])


def best_splits(tables: list[np.ndarray], arity: dict[int, int]) -> list[tuple | None]:
    """For each node ``(feature, bins to the right, means on both sides)`` of the split that lowers the squared error
    most, of equals the first; None where none does."""
    best: list[tuple | None] = []
    for f, (count, total) in enumerate(tables):
        best = best or [None] * len(count)
        order = np.broadcast_to(np.arange(count.shape[1]), count.shape)
        if f in arity:  # categories by their mean, those without rows last
            order = np.argsort(np.divide(total, count, out=np.full_like(total, np.inf), where=count > 0), axis=1, kind="stable")
        n, s = (np.cumsum(np.take_along_axis(t, order, 1), axis=1) for t in (count, total))
        for i in range(len(count)):
            nl, sl, nr, sr = n[i, :-1], s[i, :-1], n[i, -1] - n[i, :-1], s[i, -1] - s[i, :-1]
            able = np.flatnonzero((nl >= 1) & (nr >= 1))
            if len(able):
                gain = sl[able] ** 2 / nl[able] + sr[able] ** 2 / nr[able] - s[i, -1] ** 2 / n[i, -1]
                k = able[np.argmax(gain)]
                if gain.max() > (best[i][0] if best[i] else 0.0):
                    right = np.zeros(count.shape[1], bool)
                    right[order[i, k + 1 :]] = True
                    best[i] = (gain.max(), f, right, sl[k] / nl[k], sr[k] / nr[k])
    return [b and b[1:] for b in best]


class BoostedTrees(Estimator):
    """``GBTRegressor``'s fit with Spark's defaults (squared error), for any number of rows: up to ``small`` by that
    estimator, whose passes start sooner, beyond by the passes of this module. Both give the same trees."""

    def __init__(self, features: str = "features", label: str = "label", seed: int = 42, trees: int = TREES, small: int = 1_000_000):
        super().__init__()
        self.features, self.label, self.seed, self.trees, self.small = features, label, seed, trees, small

    def _fit(self, dataset: DataFrame) -> Model:
        rows = dataset.select(self.features, F.col(self.label).cast("double").alias("y"))
        n = rows.count()
        if n <= self.small:
            est = GBTRegressor(featuresCol=self.features, labelCol=self.label, predictionCol="prediction", maxIter=self.trees, seed=self.seed)
            return est.fit(dataset)
        bins = self._bins(rows, n)
        state = rows.select(vector_to_array(self.features).alias("x"), "y").mapInArrow(_binned(bins), _CHUNKS).persist()
        found: list[tuple[list, np.ndarray]] = []
        try:
            for t in range(self.trees):
                if found:  # the first pass for the next tree makes its residuals
                    last, state = state, state.mapInArrow(_without(len(bins.groups), *found[-1]), _CHUNKS).persist()
                levels, leaves = [], np.zeros(1)
                while len(levels) < DEPTH:
                    sums = state.mapInArrow(_level_sums(bins, levels), _SUMS).repartition(1).mapInArrow(_added, _SUMS)
                    # an aggregate reads to the end: a worker that is not read to the end is not used again
                    tables = bins.tables(np.frombuffer(sums.agg(F.first("sums")).first()[0]), len(leaves))
                    if not levels:
                        leaves = np.array([tables[0][1].sum() / tables[0][0].sum()])
                        if found:
                            last.unpersist()
                    splits, level = best_splits(tables, bins.arity), {}
                    leaves = np.repeat(leaves, 2)
                    for i, split in enumerate(splits):
                        if split:
                            bins.turns(i, len(splits), split[0], split[1], level)
                            leaves[2 * i : 2 * i + 2] = split[2:]
                    levels.append(level)
                    if not level:
                        break
                # the gradient is twice the residual; the first tree learns the label itself
                found.append((levels, leaves * (2 * STEP if found else 1.0)))
        finally:
            state.unpersist()
        return BoostedTreesModel(bins, found, self.features)

    def _bins(self, rows: DataFrame, n: int) -> Bins:
        size, arity = category_counts(rows, self.features)
        most = min(BINS, n)
        if max(arity.values(), default=0) > most:
            raise ValueError(f"a feature has more than {most} categories")
        numbers = [f for f in range(size) if f not in arity]
        share = min(1.0, SPLIT_ROWS / n)
        found: dict[int, list] = {f: [] for f in numbers}
        if numbers:
            x = vector_to_array(self.features)
            each = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), x[f].alias("x")) for f in numbers])).alias("v")
            counts = _sampled(rows, share, self.seed).select(each).where("v.x <> 0").groupBy("v.f", "v.x").agg(F.count(F.lit(1)).alias("n"))
            for f, value, c in counts.agg(F.collect_list(F.struct("f", "x", "n"))).first()[0]:  # at most so many as the sample has
                found[f].append((value, c))
        return Bins(size, arity, {f: thresholds(found[f], share * n, most - 1) for f in numbers})


class BoostedTreesModel(Model):
    """Predictions of :class:`BoostedTrees`: ``trees`` are levels and leaves, the leaves with their weight."""

    def __init__(self, bins: Bins, trees: list[tuple[list, np.ndarray]], features: str, prediction: str = "prediction"):
        super().__init__()
        self.bins, self.trees, self.features, self.prediction = bins, trees, features, prediction

    def _transform(self, dataset: DataFrame) -> DataFrame:
        bins, trees = self.bins, self.trees

        def predicted(x: pa.Array) -> pa.Array:
            codes = bins.of(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)) if len(x) else np.zeros((len(bins.groups), 0), np.uint16)
            out = np.zeros(codes.shape[1])
            for levels, leaves in trees:
                out += leaves[_node_of(codes, levels)]
            return pa.array(out)

        return dataset.withColumn(self.prediction, F.arrow_udf(predicted, "double")(vector_to_array(self.features)))
