"""Nearest vectors: exact search against brute force, the index's recall against the exact search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import neighbours


def _cosines(v):
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    u = np.divide(v, norm, out=np.zeros_like(v), where=norm > 0)
    return u @ u.T


def _frame(spark, v, ids=None):
    ids = range(len(v)) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(x) for x in a]) for i, a in zip(ids, v, strict=True)], "id long, vec array<float>")


@pytest.fixture(scope="module")
def some():
    return np.round(np.random.default_rng(1).normal(size=(130, 6)), 1).astype(np.float32).astype(float)


@pytest.mark.parametrize(("k", "block"), [(1, 4096), (7, 10), (500, 50)])
def test_exact_by_force(spark, some, k, block):
    v = some.copy()
    v[40:60] = v[7]  # copies: of equals the least ids
    v[100] = 0.0
    df = _frame(spark, v).repartition(4)
    out = neighbours.nearest_exact(df, df.where("id % 5 = 0"), "id", "vec", k, block).collect()
    cos = np.round(_cosines(v), 12)
    got = {}
    for r in sorted(out, key=lambda r: (r.id, r.rank)):
        got.setdefault(r.id, []).append(r.neighbour)
    assert set(got) == set(range(0, 130, 5))
    for i, near in got.items():
        order = sorted((j for j in range(130) if j != i), key=lambda j: (-cos[i, j], j))
        assert len(near) == min(k, 129)
        assert [cos[i, j] for j in near] == pytest.approx([cos[i, j] for j in order[:k]], abs=1e-9)
        if i not in range(40, 60) and i not in (7, 100) and k == 7:
            assert near == order[:k]


def test_one_bucket_is_exact(spark, some):
    df = _frame(spark, some)
    exact = {(r.id, r.rank): r.similarity for r in neighbours.nearest_exact(df, df, "id", "vec", 5).collect()}
    index = {(r.id, r.rank): r.similarity for r in neighbours.nearest_by_index(df, "id", "vec", 5, tables=1).collect()}
    assert set(index) == set(exact) and all(index[k] == pytest.approx(exact[k]) for k in exact)


def test_recall_of_the_index(spark):
    """4,000 vectors of 32 dimensions around 60 places, and one vector 1,300 times: buckets of 256 rows."""
    rng = np.random.default_rng(4)
    places = rng.normal(size=(60, 32))
    v = places[rng.integers(0, 60, 4000)] + rng.normal(size=(4000, 6)) @ rng.normal(size=(6, 32)) * 0.3
    v = np.concatenate([v, np.repeat(v[:1], 1300, axis=0)])
    df = _frame(spark, v)
    cos = _cosines(v)
    np.fill_diagonal(cos, -2)
    least = -np.partition(-cos, 9, axis=1)[:, 9]
    out = neighbours.nearest_by_index(df, "id", "vec", 10, tables=8, bucket=256).collect()
    found = np.zeros(len(v))
    for r in out:
        assert r.similarity == pytest.approx(cos[r.id, r.neighbour], abs=1e-6) and r.id != r.neighbour
        found[r.id] += r.similarity >= least[r.id] - 1e-6
    assert len(out) == 10 * len(v)  # every row has its neighbours
    assert found[:4000].mean() / 10 >= 0.9 and found.mean() / 10 >= 0.9


def test_recall_on_the_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    exact = neighbours.nearest_exact(df, df.where("vec_id % 100 = 0"), "vec_id", "embedding", 10)
    index = neighbours.nearest_by_index(df, "vec_id", "embedding", 10, bucket=256)
    both = exact.join(index.select("vec_id", "neighbour"), ["vec_id", "neighbour"]).count()
    assert both >= 0.9 * exact.count()


def test_odd_vectors(spark):
    kind = "id long, vec array<float>, key string, pos int, rank int"
    rows = [(1, [1.0, 0.0], "x", 1, 1), (2, None, "x", 1, 1), (3, [0.0, 0.0], "x", 1, 1), (2**60 + 1, [2.0, 0.0], "x", 1, 1)]
    df = spark.createDataFrame(rows, kind)
    for out in (neighbours.nearest_by_index(df, "id", "vec", 2), neighbours.nearest_exact(df, df, "id", "vec", 2)):
        got = {(r.id, r.rank): (r.neighbour, r.similarity) for r in out.collect()}
        assert got[1, 1] == (2**60 + 1, 1.0) and got[1, 2] == (3, 0.0) and len(got) == 6
    empty = spark.createDataFrame([], kind)
    assert neighbours.nearest_by_index(empty, "id", "vec", 2).count() == 0
    assert neighbours.nearest_exact(empty, empty, "id", "vec", 2).count() == 0
    one = df.where(F.col("id") == 1)
    assert neighbours.nearest_by_index(one, "id", "vec", 2).count() == 0


def test_a_task_holds_few_cosines_at_a_time():
    import tracemalloc
    from types import SimpleNamespace

    import pyarrow as pa

    rng = np.random.default_rng(3)
    v = rng.normal(size=(9000, 4))
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(9000)), pa.array(list(v), pa.list_(pa.float64()))], ["key", "vec"])
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    held = SimpleNamespace(value=(np.arange(1000), unit[:1000]))
    tracemalloc.start()
    out = list(neighbours._against(held, 3)([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6  # all cosines at once are 72 MB, and several copies were made
    got = {}
    for b in out:
        for key, near in zip(b["key"].to_pylist(), b["neighbour"].to_pylist(), strict=True):
            got.setdefault(key, []).append(near)
    sims = unit[:1000] @ unit.T
    sims[np.arange(1000), np.arange(1000)] = -np.inf
    assert all(set(got[i]) == set(np.argsort(-sims[i])[:3]) for i in range(1000))
