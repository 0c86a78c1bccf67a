"""Nearest vectors by cosine (M17), exactly for a stated set of queries and by an index for all rows.

The index draws random hyperplanes. A vector's signs against them are its code, one per table of
hyperplanes; vectors of small angle agree in most signs. Per table the rows are put in the order of their
codes and cut into buckets of ``bucket`` rows, so a bucket has a bounded size however many vectors
share a code (copies, a hot vector), and no row is left out. Inside a bucket all are compared by one
matrix product and each row keeps its best ``k``; the best of all tables are ranked by their cosines.
More tables or larger buckets find more: where vectors lie without structure in all their dimensions,
what is found is about the share of rows that a row is compared with.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.positions import global_index

BITS = 60


def _unit(batch: pa.RecordBatch, column: str) -> np.ndarray:
    """Rows of an array column as unit vectors; a vector of length 0 stays 0."""
    rows = batch[column]
    flat = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    v = flat.reshape(len(rows), -1)
    norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return np.divide(v, norm, out=np.zeros_like(v), where=norm > 0)


def _best(sims: np.ndarray, keys: np.ndarray, k: int) -> np.ndarray:
    """For each row of ``sims`` the places of its ``k`` greatest entries, of equals the least ``keys``."""
    k = min(k, sims.shape[1])
    if k == sims.shape[1]:
        return np.stack([np.lexsort((r, -s)) for s, r in zip(sims, np.broadcast_to(keys, sims.shape), strict=True)])
    least = -np.partition(-sims, k - 1, axis=1)[:, k - 1]
    out = np.empty((len(sims), k), np.int64)
    for i, (s, low) in enumerate(zip(sims, least, strict=True)):
        near = np.flatnonzero(s >= low)
        own = keys[i] if keys.ndim == 2 else keys
        out[i] = near[np.lexsort((own[near], -s[near]))[:k]]
    return out


def nearest_exact(vectors: DataFrame, queries: DataFrame, key: str, vec: str, k: int = 10, block: int = 4096) -> DataFrame:
    """``(key, rank, neighbour, similarity)``: for each row of ``queries`` the ``k`` rows of ``vectors`` with the
    greatest cosine, of equals those with the least key; never itself. Keys are whole numbers, each
    stands once. A vector of length 0 has cosine 0 with all.

    The queries go to all tasks a block of ``block`` at a time; every task keeps the best ``k`` of its rows
    for each, so per block and task ``k`` rows a query are shuffled. A task holds the cosines of ``ASKED``
    queries with ``HELD`` rows at a time, whatever the block and the batch.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).cast("long").alias("key"), F.col(vec).cast("array<double>").alias("vec")).where("vec is not null")
    asked = queries.select(F.col(key).cast("long").alias("key"), F.col(vec).cast("array<double>").alias("vec")).where("vec is not null")
    asked = global_index(asked, ["key"], "pos")
    parts = math.ceil(asked.count() / block)
    found = spark.createDataFrame([], "key long, neighbour long, similarity double")
    for b in range(parts):
        some = asked.where((F.col("pos") >= b * block) & (F.col("pos") < (b + 1) * block)).select("key", "vec").toArrow()  # at most block rows
        ids = some["key"].to_numpy()
        held = spark.sparkContext.broadcast((ids, _unit(some.combine_chunks().to_batches()[0], "vec")))
        found = found.unionByName(rows.mapInArrow(_against(held, k), "key long, neighbour long, similarity double"))
    order = Window.partitionBy("key").orderBy(F.desc("similarity"), "neighbour")  # k rows a task for each query
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("key").alias(key), "rank", "neighbour", "similarity")


#: Queries and rows that a task compares by one matrix product.
ASKED, HELD = 256, 2048


def _against(held, k):
    def search(batches):
        ids, q = held.value
        blocks = [(ids[low : low + ASKED], q[low : low + ASKED]) for low in range(0, len(ids), ASKED)]
        best = [(np.zeros((len(own), 0)), np.zeros((len(own), 0), np.int64)) for own, _ in blocks]
        for batch in batches:
            for some in (batch.slice(low, HELD) for low in range(0, batch.num_rows, HELD)):
                keys, v = some["key"].to_numpy(), _unit(some, "vec")
                for b, (own, asked) in enumerate(blocks):
                    sims = asked @ v.T
                    sims[own[:, None] == keys[None, :]] = -np.inf
                    sims = np.concatenate([best[b][0], sims], axis=1)
                    every = np.concatenate([best[b][1], np.broadcast_to(keys, (len(own), len(keys)))], axis=1)
                    at = _best(sims, every, k)
                    best[b] = np.take_along_axis(sims, at, 1), np.take_along_axis(every, at, 1)
        for (own, _), (top_s, top_k) in zip(blocks, best, strict=True):
            row = np.repeat(own, top_s.shape[1])
            real = np.isfinite(top_s.ravel())
            if real.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row[real]), pa.array(top_k.ravel()[real]), pa.array(top_s.ravel()[real])], ["key", "neighbour", "similarity"]
                )

    return search


def hyperplane_codes(vectors: DataFrame, key: str, vec: str, tables: int, seed: int) -> DataFrame:
    """``(tab, code, key)``: for each table the signs of a vector against BITS random hyperplanes, as a number."""

    def code(batches):
        weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        planes: dict = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            v, keys = _unit(batch, "vec"), batch["key"]
            for t in range(tables):
                if t not in planes:
                    planes[t] = np.random.default_rng((seed, t)).normal(size=(v.shape[1], BITS))
                codes = ((v @ planes[t]) >= 0) @ weights
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), t, np.int32)), pa.array(codes), keys], ["tab", "code", "key"])

    rows = vectors.select(F.col(key).cast("long").alias("key"), F.col(vec).cast("array<double>").alias("vec")).where("vec is not null")
    return rows.mapInArrow(code, "tab int, code long, key long")


def _bucket_best(k: int):
    def best(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        keys = table["key"].to_numpy()
        out: list = [[], [], []]
        if len(keys) > 1:
            v = _unit(table.to_batches()[0], "vec")
            for low in range(0, len(keys), 512):  # so many rows of the product at a time
                own = keys[low : low + 512]
                sims = v[low : low + 512] @ v.T
                sims[own[:, None] == keys[None, :]] = -np.inf
                at = _best(sims, keys, min(k, len(keys) - 1))
                for column, more in zip(out, (np.repeat(own, at.shape[1]), keys[at.ravel()], np.take_along_axis(sims, at, 1).ravel()), strict=True):
                    column.append(more)
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(np.concatenate(o) if o else [], t) for o, t in zip(out, kinds, strict=True)], names=["key", "neighbour", "similarity"])

    return best


def _top(pairs: DataFrame, k: int) -> DataFrame:
    """The best ``k`` different neighbours of each key; a key has a bounded number of rows here."""
    once = pairs.groupBy("key", "neighbour").agg(F.max("similarity").alias("similarity"))
    best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("similarity")).alias("far"), "neighbour"))), 1, k)
    rows = once.groupBy("key").agg(best.alias("best")).select("key", F.posexplode("best").alias("rank", "b"))
    return rows.select("key", (F.col("rank") + 1).alias("rank"), F.col("b.neighbour").alias("neighbour"), (-F.col("b.far")).alias("similarity"))


def nearest_by_index(
    vectors: DataFrame, key: str, vec: str, k: int = 10, tables: int = 16, bucket: int = 4096, seed: int = 42
) -> DataFrame:
    """``(key, rank, neighbour, similarity)``: for every row of ``vectors`` its nearest ``k`` by cosine, as far as the
    index finds them. Exact where a bucket holds all rows. Keys are whole numbers, each stands once.

    The order of codes is made on keys only; then every vector is shuffled once for each table, to its
    bucket there, and ``k`` rows for each come back.
    """
    rows = vectors.select(F.col(key).cast("long").alias("key"), F.col(vec).cast("array<double>").alias("vec")).where("vec is not null")
    placed = global_index(hyperplane_codes(vectors, key, vec, tables, seed), ["tab", "code", "key"], "pos")
    first = placed.groupBy("tab").agg(F.min("pos").alias("first"))  # a row for each table
    buckets = placed.join(F.broadcast(first), "tab").select("tab", F.expr(f"(pos - first) div {int(bucket)}").alias("bucket"), "key")
    found = buckets.join(rows, "key").groupBy("tab", "bucket").applyInArrow(_bucket_best(k), "key long, neighbour long, similarity double")
    return _top(found, k).select(F.col("key").alias(key), "rank", "neighbour", "similarity")
