"""Line deduplication by a deletion-neighbourhood join.

Edits are counted in words: a line is near another if inserting, deleting or replacing one word
makes them equal and it has at least ``min_words`` words, so that at least four of
five words agree. Shorter lines must be equal in all their words.

1. Every line is hashed once; equal lines meet and the earliest stands for them.
2. Two lines within one edit, the longer of m words, agree in their first m // 2 or in their last
   m - m // 2 words. Lines that share neither half, for the same m, with any other line have no
   neighbour and go no further; nothing is lost by this. Which halves are shared is sent to the
   tasks as a bitmap of ``2**BITS`` bits; a bit set by chance only lets a line go further.
3. The others emit their deletion neighbourhood: for every word, the hash of the line without it
   and where it was, and the whole line. Equal variants with equal places differ by one
   replacement; a variant equal to a whole line differs by one insertion. Each member of a group of
   equal variants is paired with the group's earliest line only, found by an aggregate, so the
   pairs stay linear and Spark can split a hot group's join. Variants are dealt once; those that
   have a partner are emitted again, told by a bitmap.
4. The pairs are verified by the edit distance of the two lines.

A line goes if an earlier line (by document id, then place) is equal or within the bound.

Defined results: lines are cut at line feeds; lines without a word always stay; equality and edits
look at words only, not at the white space between them; a null text stays null, a text that loses
all its lines becomes empty, and no document is dropped; rows that repeat an id are documents
of their own if their texts differ, in the order of a hash of the text, and one document if not (each
keeps its lines); a null id is earlier than any other; an empty table gives no rows; other columns,
whatever their names, pass unchanged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.stage import columns_of, written
from tessera.llm.words import Words, WordHasher, chunks, mix64, pieces, seeds

SPACE = b" \t\r\x0b\x0c"
#: log2 of the bits that say which halves of lines are shared
BITS = 26


class _Lines:
    """Lines of a run of texts: of each line its text, place and words."""

    def __init__(self, hasher: WordHasher, data: np.ndarray, at: np.ndarray):
        b = data[at[0] : at[-1]]
        edge = at - at[0]
        feeds = np.flatnonzero(b == 10)
        # a line starts at each text's first byte and after each feed
        begin = np.concatenate([edge[:-1], feeds + 1])
        text = np.concatenate([np.arange(len(at) - 1), np.searchsorted(edge, feeds, "right") - 1])
        order = np.lexsort((np.arange(len(begin)), begin, text))
        self.begin, self.text = begin[order], text[order]
        n = len(self.begin)
        last = np.ones(n, bool)
        last[:-1] = self.text[1:] != self.text[:-1]
        after = np.empty(n, np.int64)
        after[:-1] = self.begin[1:] - 1
        after[last] = edge[1:][self.text[last]]
        self.end = after
        start = np.searchsorted(self.text, np.arange(len(at) - 1))
        self.place = np.arange(n) - start[self.text]
        words = hasher.cut(data, at)
        self.first, self.stop = np.searchsorted(words.begin, self.begin), np.searchsorted(words.begin, self.end)
        self.count = self.stop - self.first
        self.words: Words = words


class _Chain:
    """Hashes of word runs from prefix sums: two independent 64-bit values."""

    def __init__(self, code: np.ndarray, salt: int):
        base = (int(seeds(1, 300 + salt)[0]) | 1) & ((1 << 64) - 1)
        n = len(code) + 1
        self.power = np.cumprod(np.full(n, base, np.uint64)) * np.uint64(pow(base, -1, 1 << 64))
        self.back = np.cumprod(np.full(n, pow(base, -1, 1 << 64), np.uint64)) * np.uint64(base)
        self.total = np.zeros(n, np.uint64)
        np.cumsum(mix64(code + np.uint64(salt)) * self.power[:-1], out=self.total[1:])

    def run(self, low, high):
        """Hash of the words from ``low`` to before ``high``, the first at power 0."""
        return (self.total[high] - self.total[low]) * self.back[low]


def _hasher() -> WordHasher:
    return WordHasher(SPACE + b"\n")


def _keys(lines: _Lines, min_words: int):
    """Of the lines with words: their numbers, two hashes, four hashes of halves (as a line of m words
    and as a shorter partner of one) and which of these count."""
    here = np.flatnonzero(lines.count > 0)
    a, b, n = lines.first[here], lines.stop[here], lines.count[here]
    one, two = _Chain(lines.words.hash, 1), _Chain(lines.words.hash, 2)
    h1, h2 = mix64(one.run(a, b)).view(np.int64), mix64(two.run(a, b)).view(np.int64)
    keys, use = np.empty((len(here), 4), np.int64), np.empty((len(here), 4), bool)
    for j, m in enumerate((n, n + 1)):  # for partners as long or shorter; for one longer by one
        head = m // 2
        for side, (x, y) in enumerate(((a, a + head), (b - (m - head), b))):
            keys[:, 2 * j + side] = mix64(one.run(x, y) + mix64((m * 2 + side).astype(np.uint64))).view(np.int64)
            use[:, 2 * j + side] = m >= min_words
    return here, h1, h2, keys, use


def line_keys(docs: DataFrame, min_words: int) -> DataFrame:
    """``(d, place, h1, h2, keys)`` of every line with words; ``keys``: the hashes of its halves."""

    def emit(batches):
        hasher = _hasher()
        for batch in batches:
            data, at = pieces(batch["text"])
            for low, high in chunks(at):
                lines = _Lines(hasher, data, at[low : high + 1])
                here, h1, h2, keys, use = _keys(lines, min_words)
                offsets = np.concatenate([[0], np.cumsum(use.sum(1))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch["d"].take(pa.array(low + lines.text[here])), pa.array(lines.place[here].astype(np.int32)),
                     pa.array(h1), pa.array(h2), pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[use]))],
                    ["d", "place", "h1", "h2", "keys"],
                )

    return docs.select("d", F.col("row.text").alias("text")).mapInArrow(
        emit, "d struct<id:long,t:long>, place int, h1 long, h2 long, keys array<long>"
    )


def shared_halves(keyed: DataFrame) -> np.ndarray:
    """The bitmap of the halves that two different lines share."""
    halves = keyed.select("h1", F.explode("keys").alias("key"))
    shared = halves.groupBy("key").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).where("low <> high")

    return _bitmap(shared.select("key"))


def _bitmap(keys: DataFrame) -> np.ndarray:
    """A bitmap of ``2**BITS`` bits, the one that each hash in column ``key`` begins with set."""
    place = F.shiftrightunsigned("key", 64 - BITS)
    words = keys.groupBy(F.shiftright(place, 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, int(shiftrightunsigned(key, {64 - BITS}) & 63))")).alias("bits")
    )
    found = columns_of(words)  # at most 2**BITS / 64 rows
    out = np.zeros(1 << (BITS - 6), np.int64)
    out[found["word"]] = found["bits"]
    return out


def _is_set(bitmap: np.ndarray, key: np.ndarray) -> np.ndarray:
    place = (key.view(np.uint64) >> np.uint64(64 - BITS)).astype(np.int64)
    return (bitmap[place >> 6] >> (place & 63) & 1).astype(bool)


def near_lines(docs: DataFrame, bitmap: np.ndarray, min_words: int) -> DataFrame:
    """``(h1, h2, d, place, line)`` of the lines with a half in the bitmap."""
    held = docs.sparkSession.sparkContext.broadcast(bitmap)

    def emit(batches):
        hasher, bits = _hasher(), held.value
        for batch in batches:
            data, at = pieces(batch["text"])
            for low, high in chunks(at):
                lines = _Lines(hasher, data, at[low : high + 1])
                here, h1, h2, keys, use = _keys(lines, min_words)
                hit = _is_set(bits, keys) & use
                some = np.flatnonzero(hit.any(1))
                own = here[some]
                part = data[at[low] : at[high]]
                text = [bytes(part[lines.begin[i] : lines.end[i]]) for i in own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h1[some]), pa.array(h2[some]), batch["d"].take(pa.array(low + lines.text[own])),
                     pa.array(lines.place[own].astype(np.int32)), pa.array(text, pa.binary())],
                    ["h1", "h2", "d", "place", "line"],
                )

    return docs.select("d", F.col("row.text").alias("text")).mapInArrow(
        emit, "h1 long, h2 long, d struct<id:long,t:long>, place int, line binary"
    )


def line_variants(lines: DataFrame, min_words: int, kind: str, bitmap: np.ndarray | None = None) -> DataFrame:
    """Hashed keys ``(key, at)`` of the lines ``(at, line)``. ``kind``: ``whole``, the line itself;
    ``added``, the line without each of its words, equal to the whole of a line without it;
    ``replaced``, the same with the word's place, equal for lines that differ in that word. Lines
    below ``min_words`` give the whole only. With a bitmap, only keys whose bit is set."""
    held = None if bitmap is None else lines.sparkSession.sparkContext.broadcast(bitmap)

    def emit(batches):
        hasher = _hasher()
        for batch in batches:
            data, edge = pieces(batch["line"])
            for low, high in chunks(edge):
                words = hasher.cut(data, edge[low : high + 1])
                a, b = words.first[:-1], words.first[1:]
                n = b - a
                chain = _Chain(words.hash, 1)
                if kind == "whole":
                    row, code, size = np.arange(len(n)), chain.run(a, b), n
                else:
                    reps = np.where(n >= min_words, n, 0)
                    row = np.repeat(np.arange(len(n)), reps)
                    cut = np.arange(len(row)) - np.repeat(np.cumsum(reps) - reps, reps)
                    mid, size = a[row] + cut, n[row] - 1  # the word left out
                    code = chain.run(a[row], mid) + chain.run(mid + 1, b[row]) * chain.power[cut]
                key = mix64(code + mix64(size.astype(np.uint64)))
                if kind == "replaced":
                    key = mix64(key + mix64(cut.astype(np.uint64) + np.uint64(1)))
                key = key.view(np.int64)
                if held is not None:
                    some = _is_set(held.value, key)
                    key, row = key[some], row[some]
                yield pa.RecordBatch.from_arrays([pa.array(key), batch["at"].take(pa.array(low + row))], ["key", "at"])

    return lines.select("at", "line").mapInArrow(emit, "key long, at struct<d:struct<id:long,t:long>,place:int>")


def within_edits(a: bytes, b: bytes) -> bool:
    """Whether inserting, deleting or replacing one word, or none, makes the lines equal."""
    x, y = a.split(), b.split()
    if len(x) > len(y):
        x, y = y, x
    if len(y) - len(x) > 1:
        return False
    head = 0
    while head < len(x) and x[head] == y[head]:
        head += 1
    rest = len(x) - head
    skip = 1 if len(x) == len(y) else 0  # a replaced word is passed over in both
    return rest == 0 or x[head + skip :] == y[head + 1 :]


def _verified(pairs: DataFrame) -> DataFrame:
    def check(batches):
        for batch in batches:
            good = [within_edits(a, b) for a, b in zip(batch["line"].to_pylist(), batch["other"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch["later"]], ["later"]).filter(pa.array(good, pa.bool_()))

    return pairs.select("later", "line", "other").mapInArrow(check, "later struct<d:struct<id:long,t:long>,place:int>").distinct()


def _repeats(source: DataFrame, min_words: int) -> DataFrame:
    """``(d, places)`` of the lines that go; ``source`` has ``row`` and its key ``d``."""
    keyed = written(line_keys(source, min_words), "lines")
    spot = F.struct("d", "place")
    # equal lines: all but the earliest go
    many = keyed.groupBy("h1", "h2").agg(F.min(spot).alias("at"), F.count(F.lit(1)).alias("n")).where("n > 1")
    equal = keyed.select("h1", "h2", spot.alias("own")).join(many, ["h1", "h2"]).where("own <> at").select("own")
    found = near_lines(source, shared_halves(keyed), min_words)
    lines = written(found.groupBy("h1", "h2").agg(F.min(spot).alias("at"), F.first("line").alias("line")), "near")
    # of equal variants the earliest line; then the others, found again with a bitmap of such keys
    every = line_variants(lines, min_words, "replaced")
    live = every.groupBy("key").agg(F.min("at").alias("earlier"), F.max("at").alias("last")).where("earlier <> last")
    live = written(live.select("key", "earlier"), "variants")
    again = line_variants(lines, min_words, "replaced", _bitmap(live))
    replaced = again.withColumnRenamed("at", "later").join(live, "key").select("later", "earlier")
    whole = line_variants(lines, min_words, "whole")
    longer = line_variants(lines, min_words, "added", _bitmap(whole))
    added = longer.join(whole.withColumnRenamed("at", "other"), "key").select(
        F.greatest("at", "other").alias("later"), F.least("at", "other").alias("earlier")
    )
    pairs = replaced.unionByName(added).where("later <> earlier").distinct()
    pairs = pairs.join(lines.select(F.col("at").alias("later"), "line"), "later")
    pairs = pairs.join(lines.select(F.col("at").alias("earlier"), F.col("line").alias("other")), "earlier")
    goes = equal.select("own.*").unionByName(_verified(pairs).select("later.*"))
    # a line equal to one that goes is not the earliest, so it goes already
    return goes.groupBy("d").agg(F.collect_set("place").alias("places"))


def _key(doc_id: str, text: str):
    """Documents by id, null ids first, and by a hash of the text: rows that share an id, or have none, are
    documents of their own if their texts differ."""
    return F.struct(F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63))).alias("id"), F.xxhash64(text).alias("t"))


def drop_repeated_lines(docs: DataFrame, min_words: int = 5) -> DataFrame:
    """``docs`` without repeated lines: all columns as they are, but for ``text``.

    ``min_words``: lines with fewer words go only if they are equal to an earlier one.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    source = docs.select(F.struct(*columns).alias("row")).withColumn("d", _key("row.doc_id", "row.text"))
    goes = written(_repeats(source, min_words), "goes")
    # documents that keep all their lines need not be dealt by id; a bitmap, bounded as above, tells
    # most of them
    held = docs.sparkSession.sparkContext.broadcast(_bitmap(goes.select(F.xxhash64("d").alias("key"))))

    @F.pandas_udf("boolean")
    def loses(keys):
        import pandas as pd

        return pd.Series(_is_set(held.value, keys.to_numpy(np.int64)))

    at = docs.columns.index("text")

    def remove(batches):
        for batch in batches:
            row, places = batch["row"], batch["places"]
            text = row.field(at)
            asked = places.is_valid().to_numpy(zero_copy_only=False) & text.is_valid().to_numpy(zero_copy_only=False)
            some = np.flatnonzero(asked)
            changed = []
            for i in some.tolist():
                out = set(places[i].as_py())
                changed.append("\n".join(x for k, x in enumerate(text[i].as_py().split("\n")) if k not in out))
            columns = row.flatten()
            columns[at] = pc.replace_with_mask(text, pa.array(asked), pa.array(changed, text.type))
            row = pa.StructArray.from_arrays(columns, fields=list(row.type))
            yield pa.RecordBatch.from_arrays([row], ["row"])

    some = loses(F.xxhash64("d"))
    joined = source.where(some).join(goes.hint("merge"), "d", "left").select("row", "places")
    kind = source.select("row").schema
    return joined.mapInArrow(remove, kind).unionByName(source.where(~some).select("row")).select("row.*")
