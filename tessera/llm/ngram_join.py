"""Jaccard join on word shingles with Bayesian candidate pruning.

1. Equal texts are one class; its least id stands for it. Every text gets MinHash values.
2. Bands of the values hash texts together. Each is linked with the least id of its band, which
   keeps a hot band's edges linear; connected components of these edges hold every candidate pair.
3. The texts of a component are split into blocks of bounded size; a cell compares two blocks.
   MinHash values are compared a few at a time, and a pair is dropped once the posterior
   probability (uniform prior) that its similarity reaches the threshold falls below the
   tolerance. The rest is verified exactly on the shingle sets.
4. A cell returns, for each text, its number of links and the least text it hangs together with in
   that cell; a second run of components over these stars gives the classes.

No pair leaves a cell. A text is copied once per block of its component.

A pair at the threshold misses all ``bands`` with probability (1 - threshold^rows)^bands: 3e-6 at
0.8 with 32 bands of 5; the tolerance adds at most as much per comparison step.

Defined results: words are runs without ASCII white space, shingles are sets; a text of fewer than
``width`` words is one shingle of all its words; null texts and texts without a word link with
nothing and are classes of their own; repeated rows are copies (rows of one id count once each);
a null id forms no class and is left out; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.components import components
from tessera.llm.stage import written
from tessera.llm.words import WordHasher, chunks, mix64, pieces, seeds, shingles


def needed_matches(threshold: float, total: int, tolerance: float) -> np.ndarray:
    """For n values compared, the least number of equal ones with which the posterior probability
    of a similarity of at least ``threshold`` is not below ``tolerance``.

    With a uniform prior, that probability after m of n is P(Binomial(n + 1, threshold) <= m).
    """
    need = np.zeros(total + 1, np.int64)
    for n in range(1, total + 1):
        below = 0.0
        for m in range(n + 1):
            below += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if below >= tolerance:
                need[n] = m
                break
    return need


def signatures(docs: DataFrame, width: int = 5, bands: int = 32, rows: int = 5) -> DataFrame:
    """``doc_id, k1, k2`` (digest of the text), ``n_words`` and ``sig``: ``bands * rows`` MinHash
    values of 16 bits; null without words."""
    total = bands * rows

    def sign(batches):
        import hashlib

        hasher = WordHasher()
        factor, shift = seeds(total, 3) | np.uint64(1), seeds(total, 4)
        for batch in batches:
            data, at = pieces(batch["text"])
            n = len(at) - 1
            key = np.frombuffer(
                b"".join(hashlib.blake2b(data[at[i] : at[i + 1]], digest_size=16).digest() for i in range(n)), np.int64
            ).reshape(n, 2)
            sig = np.zeros((n, total), "<u2")
            count = np.zeros(n, np.int64)
            for low, high in chunks(at):
                words = hasher.cut(data, at[low : high + 1])
                count[low:high] = np.diff(words.first)
                code, text = shingles(words, width)
                if not len(code):
                    continue
                have, start = np.unique(text, return_index=True)
                room = np.empty_like(code)
                for k in range(total):
                    np.multiply(code, factor[k], out=room)
                    np.add(room, shift[k], out=room)
                    least = np.minimum.reduceat(room, start)
                    sig[low + have, k] = (mix64(least) & np.uint64(0xFFFF)).astype("<u2")
            values = [s.tobytes() if c else None for s, c in zip(sig, count, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(key[:, 0].copy()), pa.array(key[:, 1].copy()), pa.array(count),
                 pa.array(values, pa.binary())],
                ["doc_id", "k1", "k2", "n_words", "sig"],
            )

    kinds = "doc_id long, k1 long, k2 long, n_words long, sig binary"
    rows_ = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null")
    return rows_.mapInArrow(sign, kinds)


def band_keys(texts: DataFrame, bands: int, rows: int) -> DataFrame:
    """``(rep, band)``: one row per text and band, the band's values hashed with its number."""

    def keys(batches):
        salt, factor = seeds(bands, 5), seeds(rows, 6) | np.uint64(1)
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch["sig"].to_pylist()), "<u2").reshape(-1, bands, rows).astype(np.uint64)
            code = np.zeros(sig.shape[:2], np.uint64)
            for j in range(rows):
                code = mix64(code * factor[j] + sig[:, :, j] + np.uint64(1))
            code = mix64(code + salt)
            rep = np.repeat(batch["rep"].to_numpy(), bands)
            yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array(code.ravel().view(np.int64))], ["rep", "band"])

    return texts.select("rep", "sig").mapInArrow(keys, "rep long, band long")


def _pairs(a, b, same: bool, need: np.ndarray, step: int, threshold: float):
    """Links between the texts of two blocks: ``(i, j)`` arrays. ``a``, ``b``: lists of
    (signature, shingle array)."""
    left, right = np.stack([x[0] for x in a]), np.stack([x[0] for x in b])
    total = left.shape[1]
    equal = np.zeros((len(a), len(b)), np.int16)
    for k in range(min(step, total)):
        equal += left[:, k, None] == right[None, :, k]
    alive = equal >= need[min(step, total)]
    if same:
        alive = np.triu(alive, 1)
    i, j = np.nonzero(alive)
    equal = equal[i, j].astype(np.int64)
    for k in range(step, total, step):
        if not len(i):
            break
        high = min(k + step, total)
        for at in range(0, len(i), 1 << 17):
            part = slice(at, at + (1 << 17))
            equal[part] += (left[i[part], k:high] == right[j[part], k:high]).sum(1)
        stays = equal >= need[high]
        i, j, equal = i[stays], j[stays], equal[stays]
    if not len(i):
        return i, j
    # exact: shared shingles counted through dense numbers of the block's shingles
    sizes = np.array([len(x[1]) for x in b])
    every, number = np.unique(np.concatenate([x[1] for x in b]), return_inverse=True)
    first = np.concatenate([[0], np.cumsum(sizes)])
    mark = np.zeros(len(every) + 1, bool)
    good = np.zeros(len(i), bool)
    bounds = np.searchsorted(i, np.arange(len(a) + 1))
    for u in np.unique(i):
        own = a[u][1]
        at = np.searchsorted(every, own)
        at = at[(at < len(every)) & (every[np.minimum(at, len(every) - 1)] == own)]
        mark[at] = True
        partners = j[bounds[u] : bounds[u + 1]]
        hits = mark[np.concatenate([number[first[v] : first[v + 1]] for v in partners])]
        shared = np.add.reduceat(hits.astype(np.int64), np.concatenate([[0], np.cumsum(sizes[partners])[:-1]]))
        mark[at] = False
        good[bounds[u] : bounds[u + 1]] = shared >= threshold * (len(own) + sizes[partners] - shared) - 1e-9
    return i[good], j[good]


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least member of each item's component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def near_links(
    docs: DataFrame, width: int = 5, threshold: float = 0.8, bands: int = 32, rows: int = 5, tolerance: float = 1e-6,
    step: int = 16, block_rows: int = 2048, block_words: int = 1 << 20,
) -> DataFrame:
    """One row per document: ``doc_id, class_id`` (the least id among those it hangs together with
    by links) and ``n_links`` (documents with a similarity of at least ``threshold``, copies
    included).

    ``block_rows``, ``block_words``: texts and words that a block is meant to hold; they set how
    the work is split, not what is found.
    """
    need = needed_matches(threshold, bands * rows, tolerance)
    signed = written(signatures(docs, width, bands, rows), "signatures")
    texts = signed.groupBy("k1", "k2").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("n_words").alias("n_words"),
        F.first("sig").alias("sig"),
    )
    texts = written(texts, "texts")
    joined = texts.where("sig is not null")
    keys = band_keys(joined, bands, rows)
    first = keys.groupBy("band").agg(F.min("rep").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    stars = keys.join(first, "band").where("rep <> least").select("rep", "least")
    groups = components(stars, "rep", "least")
    size = (
        groups.join(joined, groups["node"] == joined["rep"])
        .groupBy("component")
        .agg(F.count(F.lit(1)).alias("m"), F.sum("n_words").alias("words"))
        .select(
            "component",
            F.greatest(F.lit(1), F.ceil(F.col("m") / block_rows), F.ceil(F.col("words") / block_words)).cast("int").alias("blocks"),
        )
    )
    member = groups.join(size, "component").select(
        F.col("node").alias("rep"), "component", "blocks", F.expr("int(pmod(xxhash64(node), blocks))").alias("block")
    )
    kept = ["k1", "k2", "sig", "copies", "component", "blocks", "block"]
    # where rows repeat an id with several texts, the one with the least digest counts
    chosen = joined.join(member, "rep").groupBy("rep").agg(F.min(F.struct(*kept)).alias("t")).select("rep", "t.*")
    source = docs.select(F.col("doc_id").cast("long").alias("rep"), "text")
    sets = _shingle_sets(source.join(chosen, "rep"), width)
    # a cell compares blocks x <= y; a text goes to every cell of its block
    cells = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "component", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "rep",
        "copies", "sig", "codes",
    )
    found = written(_compare(cells, need, step, threshold), "links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = components(found.where("rep <> root").select("rep", "root"), "rep", "root")
    of_text = (
        texts.select("k1", "k2", "rep", "copies", F.col("sig").isNotNull().alias("has"))
        .join(links, "rep", "left")
        .join(classes.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "k1", "k2", "has", F.coalesce("component", "rep").alias("class_id"),
            F.when(F.col("has"), F.col("copies") - 1 + F.coalesce("links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        )
    )
    return signed.select("doc_id", "k1", "k2").join(of_text, ["k1", "k2"]).select(
        "doc_id", F.when(F.col("has"), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"), "n_links"
    )


def _shingle_sets(texts: DataFrame, width: int) -> DataFrame:
    """The texts with ``codes``: their shingle hashes, sorted, each once. Where an id comes with
    several texts, only the one whose digest was chosen counts."""
    names = ["rep", "component", "blocks", "block", "copies", "sig"]

    def sets(batches):
        import hashlib

        hasher = WordHasher()
        for batch in batches:
            data, at = pieces(batch["text"])
            n = len(at) - 1
            codes = [b""] * n
            for low, high in chunks(at):
                code, text = shingles(hasher.cut(data, at[low : high + 1]), width)
                cut = np.searchsorted(text, np.arange(high - low + 1))
                for i in range(high - low):
                    codes[low + i] = np.unique(code[cut[i] : cut[i + 1]]).tobytes()
            key = np.frombuffer(
                b"".join(hashlib.blake2b(data[at[i] : at[i + 1]], digest_size=16).digest() for i in range(n)), np.int64
            ).reshape(n, 2)
            own = (key[:, 0] == batch["k1"].to_numpy()) & (key[:, 1] == batch["k2"].to_numpy())
            out = pa.RecordBatch.from_arrays(
                [*(batch[c] for c in names), pa.array(codes, pa.binary())], [*names, "codes"]
            )
            yield out.filter(pa.array(own))

    kinds = "rep long, component long, blocks int, block int, copies long, sig binary, codes binary"
    return texts.select("text", "k1", "k2", *names).mapInArrow(sets, kinds)


def _compare(cells: DataFrame, need: np.ndarray, step: int, threshold: float) -> DataFrame:
    """``rep, root, links`` of every text in every cell."""

    def settle(x: int, y: int, items: list) -> list[tuple]:
        a = [i for i in items if i[1] == x]
        b = a if x == y else [i for i in items if i[1] == y]
        if not a or not b:
            return [(i[0], i[0], 0) for i in items]
        side = lambda block: [(i[3], i[4]) for i in block]
        i, j = _pairs(side(a), side(b), x == y, need, step, threshold)
        every = a if x == y else a + b
        j = j if x == y else j + len(a)
        reps = np.array([e[0] for e in every])
        copies = np.array([e[2] for e in every])
        links = np.bincount(i, copies[j], len(every)) + np.bincount(j, copies[i], len(every))
        order = np.argsort(reps)  # so that the least member is the least id
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        root = reps[order][_roots(len(every), place[i], place[j])[place]]
        return list(zip(reps.tolist(), root.tolist(), links.astype(int).tolist(), strict=True))

    def walk(batches):
        key, items, seen = None, [], set()

        def batch_of(rows):
            columns = list(zip(*rows, strict=True)) if rows else [()] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["rep", "root", "links"])

        out = []
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("component", "x", "y", "rep", "block", "copies", "sig", "codes")]
            for c, x, y, rep, block, copies, sig, codes in zip(*columns, strict=True):
                if (c, x, y) != key:
                    if items:
                        out += settle(key[1], key[2], items)
                    key, items, seen = (c, x, y), [], set()
                if rep not in seen:  # rows may repeat
                    seen.add(rep)
                    items.append((rep, block, copies, np.frombuffer(sig, "<u2"), np.frombuffer(codes, np.uint64)))
            yield batch_of(out)
            out = []
        if items:
            yield batch_of(settle(key[1], key[2], items))

    dealt = cells.repartition("component", "x", "y").sortWithinPartitions("component", "x", "y")
    return dealt.mapInArrow(walk, "rep long, root long, links long")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """One row of each class, with all its columns: that of the least id (null ids last), then of the
    least hash of the text. Classes are formed of rows, whatever ids they share or lack; rows without
    a word stay."""
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    # rows get numbers of their own, written once so that they hold for all that follows
    held = written(held.withColumn("number", F.monotonically_increasing_id()), "rows")
    classes = near_links(held.select(F.col("number").alias("doc_id"), F.col("row.text").alias("text")), **options)
    rank = held.select(
        F.col("number").alias("doc_id"),
        F.struct(
            F.col("row.doc_id").isNull().alias("unknown"), F.col("row.doc_id").cast("long").alias("id"),
            F.xxhash64("row.text").alias("text"), "number",
        ).alias("rank"),
    )
    first = classes.join(rank, "doc_id").groupBy("class_id").agg(F.min("rank").alias("rank"))
    return held.join(first.select("rank.number"), "number", "left_semi").select("row.*")
