"""Passages that repeat across documents, by a sparse suffix array.

1. Of every ``span - key + 1`` successive word positions the one whose three-word hash is least is
   retained (a minimiser), so two copies of a passage retain the same places of it. A suffix is
   held as two hashes: of its first ``key`` words and of its first ``span`` words.
2. The retained suffixes of all documents are sorted; neighbours that agree, from different
   documents, are matches. The sort key ends with document and place, so a passage that a third of
   all documents share is spread over many tasks; runs that touch a task's edge are settled from
   what each task reports of its edges.
3. Where neighbours agree in ``span`` words, those words are a repeated passage. Where they agree
   in ``key`` words only, or at the ends of a match, the match is extended left and right: a
   document asks for the windows of ``span`` words around a matched place that it does not know to
   be covered; all documents that match there hash the windows that any of them asks for, and
   these are sorted and compared in the same way.

Every passage of ``span`` words that occurs in two documents is found: it contains a retained
place with ``key`` words after it, and so its window is compared. The result is the union of those
passages, the same as a dense suffix array gives.

Defined results: words are runs without ASCII white space; null, empty and short texts have no
passages; rows that repeat an id are one document; rows with a null id are left out; documents
without repeated passages give no row, an empty table none at all; other columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.stage import written
from tessera.llm.words import WordHasher, chunks, long_windows, pieces, windows


def _sliding(x: np.ndarray, width: int, how) -> np.ndarray:
    """``how`` over every window of ``width``, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = how(x[:-step], x[step:])
        have += step
    return x


def minimisers(code: np.ndarray, width: int) -> np.ndarray:
    """Places that are least in some window of ``width`` successive places; all of them, if there
    are fewer places than that."""
    if len(code) <= width:
        return np.arange(len(code))
    least = _sliding(code, width, np.minimum)
    pad = np.zeros(width - 1, np.uint64)
    best = _sliding(np.concatenate([pad, least, pad]), width, np.maximum)
    return np.flatnonzero(best == code)


def suffixes(docs: DataFrame, span: int, key: int) -> DataFrame:
    """The retained suffixes ``(k, g, d, pos)``; ``g`` is 0 where fewer than ``span`` words follow."""

    def emit(batches):
        hasher = WordHasher()
        for batch in batches:
            data, at = pieces(batch["text"])
            ids = batch["doc_id"]
            for low, high in chunks(at):
                words = hasher.cut(data, at[low : high + 1])
                if len(words.hash) < span:
                    continue
                place = minimisers(windows(words.hash, 3), span - key + 1)
                text = words.texts()
                left = words.first[text[place] + 1] - place  # words up to the text's end
                place = place[left >= key]
                left = words.first[text[place] + 1] - place
                k = long_windows(words.hash, key, 1)[place]
                wide = long_windows(words.hash, span, 2)
                full = left >= span
                g = np.zeros(len(place), np.uint64)
                g[full] = wide[place[full]] | np.uint64(1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k.view(np.int64)), pa.array(g.view(np.int64)), ids.take(pa.array(low + text[place])),
                     pa.array((place - words.first[text[place]]).astype(np.int32))],
                    ["k", "g", "d", "pos"],
                )

    return docs.mapInArrow(emit, "k long, g long, d long, pos int")


def compare_neighbours(rows: DataFrame) -> DataFrame:
    """Sorts ``(k, g, d, pos)`` and returns the rows whose k stands in several documents: ``(k, d,
    pos, first)``, ``first`` the least document with the same k and g, null if there is no other
    or g is 0.

    A task sees the runs of equal k, and of equal k and g, of its range; its first and last ones may
    go on in the next ranges. Each task reports these (four rows at most), and a second pass
    over the rows kept settles them.
    """
    dealt = rows.repartitionByRange("k", "g", "d", "pos").sortWithinPartitions("k", "g", "d", "pos")
    schema = pa.schema(
        [("kind", pa.int8()), ("k", pa.int64()), ("g", pa.int64()), ("d", pa.int64()), ("pos", pa.int32()),
         ("first", pa.int64()), ("several", pa.bool_()), ("open", pa.bool_()), ("last", pa.int64())]
    )

    def compare(batches):
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        k, g, d, pos = (table[c].to_numpy() for c in ("k", "g", "d", "pos"))
        n = len(k)
        new_k = np.ones(n, bool)
        new_k[1:] = k[1:] != k[:-1]
        new_g = new_k.copy()
        new_g[1:] |= g[1:] != g[:-1]
        at_k, of_k = np.flatnonzero(new_k), np.cumsum(new_k) - 1
        at_g, of_g = np.flatnonzero(new_g), np.cumsum(new_g) - 1
        low_k, high_k = np.minimum.reduceat(d, at_k), np.maximum.reduceat(d, at_k)
        low_g, high_g = np.minimum.reduceat(d, at_g), np.maximum.reduceat(d, at_g)
        several = (low_k != high_k)[of_k]
        first = pa.array(low_g[of_g], mask=~((low_g != high_g)[of_g] & (g != 0)))
        open_k = (of_k == 0) | (of_k == of_k[-1])
        open_g = ((of_g == 0) | (of_g == of_g[-1])) & (g != 0)
        keep = pa.array(several | open_k)
        nothing = pa.nulls(n, pa.int64())
        data = [pa.array(np.zeros(n, np.int8)), *map(pa.array, (k, g, d, pos)), first, pa.array(several), pa.array(open_g), nothing]
        yield from pa.Table.from_arrays(data, schema=schema).filter(keep).to_batches(1 << 16)
        ends = [(1, k[at_k[i]], 0, low_k[i], high_k[i]) for i in {0, len(at_k) - 1}]
        ends += [(2, k[at_g[i]], g[at_g[i]], low_g[i], high_g[i]) for i in {0, len(at_g) - 1} if g[at_g[i]]]
        yield pa.RecordBatch.from_pylist(
            [{"kind": a, "k": int(b), "g": int(c), "d": int(x), "last": int(y)} for a, b, c, x, y in ends], schema=schema
        )

    kinds = "kind byte, k long, g long, d long, pos int, first long, several boolean, open boolean, last long"
    found = written(dealt.mapInArrow(compare, kinds), "runs")
    ends = found.where("kind > 0").groupBy("kind", "k", "g").agg(F.min("d").alias("d"), F.max("last").alias("last"))
    ends = ends.where("d <> last").toPandas()  # at most four rows per range
    in_k = np.sort(ends[ends.kind == 1].k.to_numpy(np.int64))
    in_g = {(k, g): d for k, g, d in ends[ends.kind == 2][["k", "g", "d"]].itertuples(index=False)}

    def settle(batches):
        for batch in batches:
            k, first = batch["k"].to_numpy(), batch["first"]
            open_ = batch["open"].to_numpy(zero_copy_only=False)
            if open_.any():
                least = first.to_pylist()
                g = batch["g"].to_numpy()
                for i in np.flatnonzero(open_).tolist():
                    least[i] = in_g.get((int(k[i]), int(g[i])), least[i])
                first = pa.array(least, pa.int64())
            keep = batch["several"].to_numpy(zero_copy_only=False) | np.isin(k, in_k)
            out = pa.RecordBatch.from_arrays([batch["k"], batch["d"], batch["pos"], first], ["k", "d", "pos", "first"])
            yield out.filter(pa.array(keep))

    return found.where("kind = 0").mapInArrow(settle, "k long, d long, pos int, first long")


def _grouped(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Bounds of each row's list, and the structs of all lists."""
    size = np.array(column.value_lengths().fill_null(0), np.int64)
    return np.concatenate([[0], np.cumsum(size)]), column.flatten()


def asked_windows(matched: DataFrame, span: int, key: int) -> DataFrame:
    """``(k, asked)``: around places with hash k, which windows of ``span`` words some document does
    not know to be covered; bit j stands for the window that starts j words before the place."""
    reach = span - key

    def ask(batches):
        for batch in batches:
            bounds, found = _grouped(batch["found"])
            every, code = found.field("pos").to_numpy().astype(np.int64), found.field("k").to_numpy()
            known_ = found.field("whole").to_numpy(zero_copy_only=False)
            bits = np.zeros(len(every), np.int64)
            for i in range(len(bounds) - 1):
                part = slice(bounds[i], bounds[i + 1])
                place = every[part]
                if not len(place):
                    continue
                whole = place[known_[part]]
                low = int(place.min()) - reach  # all as seen from here; negative places are before the text
                n = int(place.max()) - low + 2 * span
                known = np.concatenate([[0], np.cumsum(_covered(whole - low, whole - low + span, n))])
                open_ = known[span:] - known[:-span] < span
                open_[: max(0, -low)] = False
                ahead = open_[(place - low)[:, None] - np.arange(reach + 1)]
                bits[part] = (ahead.astype(np.int64) << np.arange(reach + 1)).sum(1)
            some = bits != 0
            yield pa.RecordBatch.from_arrays([pa.array(code[some]), pa.array(bits[some])], ["k", "asked"])

    places = matched.groupBy("d").agg(
        F.collect_list(F.struct("pos", "k", F.col("first").isNotNull().alias("whole"))).alias("found")
    )
    return places.select("found").mapInArrow(ask, "k long, asked long").groupBy("k").agg(F.bit_or("asked").alias("asked"))


def edge_windows(docs: DataFrame, span: int) -> DataFrame:
    """``(k, g, d, pos)``: two hashes of each window that ``docs.found``, pairs of a place and the
    windows asked for around it, names."""

    def emit(batches):
        hasher = WordHasher()
        for batch in batches:
            data, at = pieces(batch["text"])
            ids = batch["d"].to_numpy()
            bounds, found = _grouped(batch["found"])
            place_, asked_ = found.field("pos").to_numpy().astype(np.int64), found.field("asked").to_numpy()
            for low, high in chunks(at):
                words = hasher.cut(data, at[low : high + 1])
                if len(words.hash) < span:
                    continue
                one, two = long_windows(words.hash, span, 3), long_windows(words.hash, span, 4)
                starts, owner = [], []
                for i in range(low, high):
                    begin, n = int(words.first[i - low]), int(words.first[i - low + 1] - words.first[i - low])
                    place, asked = place_[bounds[i] : bounds[i + 1]], asked_[bounds[i] : bounds[i + 1]]
                    if n < span or not len(place):
                        continue
                    some, back = np.nonzero(asked[:, None] >> np.arange(64) & 1)
                    start = np.unique(place[some] - back)
                    start = start[(start >= 0) & (start + span <= n)]
                    starts.append(begin + start)
                    owner.append(np.full(len(start), i))
                if not starts:
                    continue
                s, i = np.concatenate(starts), np.concatenate(owner)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one[s].view(np.int64)), pa.array((two[s] | np.uint64(1)).view(np.int64)), pa.array(ids[i]),
                     pa.array((s - words.first[i - low]).astype(np.int32))],
                    ["k", "g", "d", "pos"],
                )

    return docs.select("d", "text", "found").mapInArrow(emit, "k long, g long, d long, pos int")


def _covered(low: np.ndarray, high: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in one of the ranges."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, low, 1)
    np.add.at(step, np.minimum(high, n), -1)
    return np.cumsum(step)[:n] > 0


def _merged(starts: list[int], span: int) -> list[dict]:
    out = []
    for s in sorted(set(starts)):
        if out and s <= out[-1]["end"]:
            out[-1]["end"] = s + span
        else:
            out.append({"begin": s, "end": s + span})
    return out


def repeated_passages(docs: DataFrame, span: int = 50, key: int = 19) -> DataFrame:
    """One row per document with a passage of at least ``span`` words that another document has
    too: ``doc_id, words`` (how many of its words lie in such passages), ``passages`` (ranges of
    word numbers) and ``later`` (the ranges that an earlier document, by id, has too).

    ``key``: words that a retained suffix must share at least; the smaller, the fewer are retained.
    """
    if span - key > 62:
        raise ValueError("key must be at least span - 62")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    matched = compare_neighbours(written(suffixes(source, span, key), "suffixes"))
    matched = written(matched, "matched")
    wanted = matched.join(asked_windows(matched, span, key), "k").groupBy("d").agg(
        F.collect_list(F.struct("pos", "asked")).alias("found")
    )
    asked = edge_windows(source.withColumnRenamed("doc_id", "d").join(wanted, "d"), span)
    ends = compare_neighbours(written(asked, "windows"))
    starts = matched.unionByName(ends).where("first is not null")
    by_doc = starts.groupBy("d").agg(
        F.collect_set("pos").alias("every"), F.collect_set(F.when(F.col("first") != F.col("d"), F.col("pos"))).alias("after")
    )
    ranges = "array<struct<begin:int,end:int>>"

    def merge(batches):
        kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            passages = [_merged(x, span) for x in batch["every"].to_pylist()]
            later = [_merged(x, span) for x in batch["after"].to_pylist()]
            words = [sum(p["end"] - p["begin"] for p in x) for x in passages]
            yield pa.RecordBatch.from_arrays(
                [batch["d"], pa.array(words, pa.int64()), pa.array(passages, kind), pa.array(later, kind)],
                ["doc_id", "words", "passages", "later"],
            )

    return by_doc.mapInArrow(merge, f"doc_id long, words long, passages {ranges}, later {ranges}")
