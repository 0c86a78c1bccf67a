"""Linear regression from sums: the second moments of (1, features, label) are one aggregate, add up over
parts of the data, and hold all that a least-squares or elastic-net fit and its error need.

A moments table has the rows ``(i, j, value)`` with ``i <= j``: the sum of the products of the i-th and
j-th of ``1, x_1 .. x_d, y``. It has ``(d + 2)(d + 3) / 2`` rows whatever the number of samples.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "i int, j int, value double"


def moments(samples: DataFrame, features: str = "xs", label: str = "label") -> DataFrame:
    """The moments table of ``features`` (an array of numbers without nulls, of one length) and ``label``.

    Each task adds up its own batches as one matrix product each and gives one row per pair, so the
    shuffle carries ``(d + 2)(d + 3) / 2`` rows a task. No samples: no rows.
    """

    def products(batches):
        total = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = batch[0].flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            z = np.column_stack([np.ones(n), x, batch[1].to_numpy(zero_copy_only=False)])
            total = z.T @ z if total is None else total + z.T @ z
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "value"])

    rows = samples.select(F.col(features).cast("array<double>").alias("xs"), F.col(label).cast("double").alias("label"))
    return added(rows.mapInArrow(products, SCHEMA))


def added(*tables: DataFrame) -> DataFrame:
    """The moments of all rows behind the given tables together."""
    every = tables[0]
    for t in tables[1:]:
        every = every.unionByName(t)
    return every.groupBy("i", "j").agg(F.sum("value").alias("value"))


class Fit(NamedTuple):
    samples: int
    coefficients: list[float]
    intercept: float | None
    rmse: float | None


def fit(table: DataFrame, reg: float = 0.0, elastic_net: float = 0.0, tol: float = 1e-12, max_iter: int = 10_000) -> Fit:
    """Intercept, coefficients and in-sample RMSE from a moments table, which comes to the driver whole.

    ``reg`` and ``elastic_net`` mean what they mean in Spark's ``LinearRegression``: features and label are
    scaled by their deviations, the penalty is ``reg * (elastic_net * |b|_1 + (1 - elastic_net) / 2 *
    |b|_2^2)`` on the scaled coefficients. Features without variance get 0. No samples: no intercept and
    no RMSE.
    """
    rows = table.collect()  # (d + 2)(d + 3) / 2 rows
    if not rows:
        return Fit(0, [], None, None)
    size = max(r["j"] for r in rows) + 1
    m = np.zeros((size, size))
    for r in rows:
        m[r["i"], r["j"]] = m[r["j"], r["i"]] = r["value"]
    n = m[0, 0]
    mean = m[0] / n
    cov = m / n - np.outer(mean, mean)  # population covariances
    d = size - 2
    scale = np.sqrt(np.maximum(np.diag(cov), 0.0))
    # what a constant column leaves is rounding
    scale[np.diag(cov) <= 1e-14 * np.maximum(mean * mean, 1e-300)] = 0.0
    live = [k for k in range(1, d + 1) if scale[k] > 0]
    b = np.zeros(d)
    if live and scale[-1] > 0:
        gram = cov[np.ix_(live, live)] / np.outer(scale[live], scale[live])
        target = cov[live, -1] / (scale[live] * scale[-1])
        l1, l2 = reg / scale[-1] * elastic_net, reg / scale[-1] * (1 - elastic_net)
        scaled = _penalised(gram, target, l1, l2, tol, max_iter) if l1 else _ridge(gram, target, l2)
        b[[k - 1 for k in live]] = scaled * scale[-1] / scale[live]
    intercept = mean[-1] - mean[1:-1] @ b
    error = cov[-1, -1] - 2 * b @ cov[1:-1, -1] + b @ cov[1:-1, 1:-1] @ b
    return Fit(round(n), b.tolist(), float(intercept), float(np.sqrt(max(error, 0.0))))


def _ridge(gram, target, l2):
    return np.linalg.lstsq(gram + l2 * np.eye(len(gram)), target, rcond=None)[0]


def _penalised(gram, target, l1, l2, tol, max_iter):
    """Coordinate descent: each coefficient in turn gets its soft-thresholded best."""
    b = np.zeros(len(target))
    for _ in range(max_iter):
        moved = 0.0
        for k in range(len(b)):
            rest = target[k] - gram[k] @ b + gram[k, k] * b[k]
            new = np.sign(rest) * max(abs(rest) - l1, 0.0) / (gram[k, k] + l2)
            moved, b[k] = max(moved, abs(new - b[k])), new
        if moved < tol:
            break
    return b
