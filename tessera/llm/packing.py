"""Packing of token sequences: repeat counts of window-filling combinations by non-negative least
squares.

Every document is tokenized once, closed with an end id and cut into whole windows and one rest.
How many pieces there are of each length (at most ``window`` numbers) is all that the driver sees.
It lists the shallow combinations of lengths that fill a window, finds non-negative repeat counts
whose lengths come closest to the histogram in the least squares, rounds them without using a
length more often than it occurs, and packs what is left greedily. The plan gives, for the k-th
piece of a length, its sequence and place, so all pieces find theirs in parallel.

Defined results: a null or empty text is the end id alone; repeated documents are packed each for
itself; pieces of one length are numbered by bucket, id, start and digest, ties in any order; an
empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.stage import kept_by_worker, written


class Encoder:
    """Token ids of texts as the ``tokenizers`` library gives them, without special tokens added."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = self._ranks()

    def _ranks(self):
        """The same merges in ``tiktoken``, which is several times faster; None if they are not
        byte-level merges of the usual pattern."""
        import json

        import tiktoken

        spec = json.loads(self.tokenizer.to_str())
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        if model.get("type") != "BPE" or before.get("type") != "ByteLevel" or spec.get("normalizer"):
            return None
        if before.get("add_prefix_space") or not before.get("use_regex", True):
            return None
        # fixed values: how byte-level vocabularies write bytes as characters
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
        ranks = {
            bytes(byte[c] for c in token): i for token, i in model["vocab"].items() if token not in self.special
        }
        # fixed value: the pattern of the byte-level pre-tokenizer
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        return tiktoken.Encoding("merges", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers. A text goes through its tokenizer in one call."""
        if not text:
            return b""
        if self.fast is not None and not any(s in text for s in self.special):
            ids = self.fast.encode_to_numpy(text, disallowed_special=())
        else:
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return ids.astype("<u4", copy=False).tobytes()


def pieces_of(docs: DataFrame, tokenizer_path: str, window: int = 1024, end_id: int = 0) -> DataFrame:
    """One row per piece ``(doc_id, start, length, ids_crc32, doc_tokens)``: windows cut from the
    front, then the rest."""
    end = np.array([end_id], "<u4").tobytes()
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
         ("doc_tokens", pa.int64())]
    )

    def cut(batches):
        encoder = kept_by_worker(("encoder", tokenizer_path), lambda: Encoder(tokenizer_path))
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                code = memoryview(encoder.encode(text.as_py()) + end)
                total = len(code) // 4
                for at in range(0, total, window):
                    part = code[4 * at : 4 * (at + window)]
                    rows.append((doc, at, len(part) // 4, zlib.crc32(part), total))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

    kinds = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, kinds)


def combinations(window: int, step: int = 16) -> np.ndarray:
    """Rows of up to three lengths (0: none) that fill the window exactly: every pair, and every
    triple whose least length is a multiple of ``step``."""
    a = np.arange(1, window // 2 + 1)
    pairs = np.stack([window - a, a, np.zeros_like(a)], 1)
    low = np.arange(step, window // 3 + 1, step)
    rows = [np.array([[window, 0, 0]]), pairs]
    for c in low:
        b = np.arange(c, (window - c) // 2 + 1)
        rows.append(np.stack([window - c - b, b, np.full_like(b, c)], 1))
    return np.concatenate(rows)


def nnls_counts(combos: np.ndarray, histogram: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Non-negative x that brings the lengths used, ``A x``, close to the histogram in the least
    squares; column p of A counts the lengths of combination p.

    Accelerated projected gradient steps on ``|A x - h|^2``, A held as its non-zero entries.
    """
    size = len(histogram)
    used = (combos > 0).astype(float)

    def lengths(x):
        out = np.zeros(size)
        for j in range(combos.shape[1]):
            out += np.bincount(combos[:, j], weights=x * used[:, j], minlength=size)
        return out

    def back(r):
        return sum(r[combos[:, j]] * used[:, j] for j in range(combos.shape[1]))

    v = np.ones(len(combos))
    for _ in range(12):  # largest eigenvalue of A'A by power steps
        w = back(lengths(v))
        norm = np.linalg.norm(w)
        v = w / norm
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(y - back(lengths(y) - histogram) / (1.02 * norm), 0)
        following = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / following * (new - x)
        x, t = new, following
    return x


class Plan(NamedTuple):
    """Runs of equal windows: run r serves pieces ``low[r] <= k < high[r]`` of ``length[r]``;
    ``each[r]`` of them lie in one sequence, from ``offset[r]`` on, the first in ``sequence[r]``."""

    length: np.ndarray
    low: np.ndarray
    high: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray


def plan(histogram: np.ndarray, window: int = 1024) -> Plan:
    """Combinations and repeat counts that use every piece of the histogram exactly once."""
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    runs, taken, sequences = [], np.zeros(window + 1, np.int64), 0

    def use(parts: list[int], times: int) -> None:
        nonlocal sequences
        at = 0
        for size in sorted(set(parts), reverse=True):
            each = parts.count(size)
            runs.append((size, taken[size], taken[size] + times * each, each, sequences, at))
            taken[size] += times * each
            left[size] -= times * each
            at += each * size
        sequences += times

    if left[window]:
        use([window], int(left[window]))
    if left.any():
        combos = combinations(window)
        combos = combos[((combos == 0) | (left[combos] > 0)).all(1)]
        if len(combos):
            x = nnls_counts(combos, left.astype(float))
            for p in np.argsort(-x, kind="stable"):
                if x[p] < 0.5:
                    break
                parts = [int(s) for s in combos[p] if s]
                room = min(int(left[s]) // parts.count(s) for s in parts)
                if times := min(int(round(x[p])), room):
                    use(parts, times)
    while left.any():  # greedily: the longest rest first, then the longest that still fits
        parts, room, have = [], window, left.copy()
        while len(fits := np.flatnonzero(have[: room + 1])):
            size = int(fits[-1])
            parts.append(size)
            have[size] -= 1
            room -= size
        use(parts, min(int(left[s]) // parts.count(s) for s in set(parts)))
    rows = np.array(runs, np.int64).reshape(-1, 6)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    return Plan(*rows.T)


def pack(
    docs: DataFrame, tokenizer_path: str, window: int = 1024, end_id: int = 0, buckets: int = 256, whole_buckets: int = 16384
) -> DataFrame:
    """Packs every document of ``docs`` (``doc_id``, ``text``); one row per piece:
    ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``buckets``: parts into which the pieces of one length are split to be numbered;
    ``whole_buckets``: those of whole windows, about half of all pieces.
    """
    cut = written(pieces_of(docs, tokenizer_path, window, end_id), "pieces")
    most = max(buckets, whole_buckets)
    split = F.when(F.col("length") == window, whole_buckets).otherwise(buckets)
    cut = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), split).cast("int"))
    counts = cut.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    table = counts.toPandas().sort_values(["length", "bucket"])  # at most window x buckets + whole_buckets rows
    histogram = np.zeros(window + 1, np.int64)
    np.add.at(histogram, table["length"].to_numpy(np.int64), table["n"].to_numpy(np.int64))
    runs = plan(histogram, window)
    before = table.groupby("length")["n"].cumsum().to_numpy(np.int64) - table["n"].to_numpy(np.int64)
    key = table["length"].to_numpy(np.int64) * most + table["bucket"].to_numpy(np.int64)

    @F.pandas_udf("struct<sequence_id:long,offset:long>")
    def place(length, bucket, number):
        import pandas as pd

        size = length.to_numpy(np.int64)
        k = number.to_numpy(np.int64) - 1 + before[np.searchsorted(key, size * most + bucket.to_numpy(np.int64))]
        span = np.int64(1) << 42
        at = np.searchsorted(runs.length * span + runs.low, size * span + k, "right") - 1
        inner = k - runs.low[at]
        return pd.DataFrame({
            "sequence_id": runs.sequence[at] + inner // runs.each[at],
            "offset": runs.offset[at] + inner % runs.each[at] * size,
        })

    order = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32")
    return (
        cut.withColumn("number", F.row_number().over(order))
        .withColumn("at", place("length", "bucket", "number"))
        .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "at.sequence_id", "at.offset")
    )
