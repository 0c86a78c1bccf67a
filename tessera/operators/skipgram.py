"""Word vectors by skip-gram (M15) for vocabularies beyond the driver.

The rows are dealt into shards, as Spark's ``Word2Vec`` deals them into its partitions, and every shard
trains on all its rows. A shard holds only the words that occur in it, so neither the driver nor a task
sees the vocabulary: each shard gives the vectors of its words and how often they occurred, and a word's
vector is their weighted mean, one aggregate. A word starts from the same vector in every shard (a hash
of the word), so that what the shards learn can be averaged.

Inside a shard: one pass in order of the rows, windows of random width up to ``window`` that never leave a
row, ``negatives`` words drawn by frequency against each centre, AdaGrad steps of ``STEP`` words at a time.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words that are learned from at once.
STEP = 512
#: Rows whose words are looked up at once.
ROWS = 512
#: Words whose vectors leave a shard at once.
OUT = 1 << 15


def skip_gram_vectors(
    df: DataFrame, words_col: str, vector_size: int = 10, min_count: int = 1, window: int = 5, negatives: int = 5,
    seed: int = 42, rate: float = 0.1, partitions: int = 8, shard_words: int = 20_000_000,
) -> DataFrame:
    """``(word, vector)`` of every word of the arrays in ``words_col`` that occurs ``min_count`` times.

    A shard for every million words up to ``partitions``, and more so that none has many more than
    ``shard_words``: their number depends on the rows, not on the cluster. Null arrays and null words are left out.
    """
    rows = df.select(F.col(words_col).alias("words")).where(F.size("words") > 0)
    total = rows.agg(F.sum(F.size("words"))).first()[0] or 0
    shards = max(min(partitions, 1 + total // 1_000_000), math.ceil(total / shard_words))
    learned = rows.repartition(shards).mapInArrow(
        _trainer(vector_size, window, negatives, seed, rate), "word string, vector array<float>, n long"
    )
    share = [F.sum(F.col("vector")[i] * F.col("n")) / F.sum("n") for i in range(vector_size)]
    means = learned.groupBy("word").agg(F.array(*share).alias("v"), F.sum("n").alias("n")).where(F.col("n") >= min_count)
    return means.select("word", array_to_vector("v").alias("vector"))


def _first_vectors(words: list[str], size: int, seed: int) -> np.ndarray:
    """Numbers between -1/2 and 1/2 over ``size``, from a hash of word, place and seed."""
    code = np.array([zlib.crc32(w.encode()) | len(w) << 32 for w in words], np.uint64)
    x = code[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9 + seed)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    return (((x >> np.uint64(40)).astype(np.float32) / (1 << 24) - 0.5) / size).astype(np.float32)


class _Shard:
    """The words of one shard: what each is near to (``inner``) and what is near to it (``outer``)."""

    def __init__(self, size: int, window: int, negatives: int, seed: int, rate: float):
        self.size, self.window, self.negatives, self.seed, self.rate = size, window, negatives, seed, rate
        self.number: dict[str, int] = {}
        self.inner, self.outer = np.zeros((0, size), np.float32), np.zeros((0, size), np.float32)
        self.squares = np.zeros((2, 0), np.float32)  # of past steps, for either table
        self.times = np.zeros(0, np.int64)
        self.random = np.random.default_rng(seed)

    def numbers(self, words: list[str]) -> np.ndarray:
        known = len(self.number)
        own = np.array([self.number.setdefault(w, len(self.number)) for w in words], np.int64)
        new = [w for w, i in zip(words, own.tolist(), strict=True) if i >= known]
        if len(self.number) > len(self.inner):  # room for half as many again
            more = max(len(self.number), 3 * len(self.inner) // 2) - len(self.inner)
            grown = lambda t, axis: np.concatenate([t, np.zeros([more if a == axis else s for a, s in enumerate(t.shape)], t.dtype)], axis)
            self.inner, self.outer, self.times = grown(self.inner, 0), grown(self.outer, 0), grown(self.times, 0)
            self.squares = grown(self.squares, 1)
        if new:
            self.inner[known : known + len(new)] = _first_vectors(new, self.size, self.seed)
        return own

    def learn(self, word: np.ndarray, row: np.ndarray) -> None:
        """One step from words that stand one after another, each in its ``row``."""
        v, c = self.inner[word], self.outer[word]
        dv, dc = np.zeros_like(v), np.zeros_like(c)
        met = np.zeros(len(word), np.float32)  # context words of each centre
        reach = self.random.integers(1, self.window + 1, len(word))
        for o in range(1, min(self.window, len(word) - 1) + 1):
            together = row[o:] == row[:-o]
            left, right = slice(None, -o), slice(o, None)
            for centre, other in ((left, right), (right, left)):
                near = together & (reach[centre] >= o)
                pull = (near * _sigmoid(-(v[centre] * c[other]).sum(1)))[:, None]
                dv[centre] += pull * c[other]
                dc[other] += pull * v[centre]
                met[centre] += near
        for _ in range(self.negatives):
            other = self.random.permutation(len(word))  # words of the step, drawn as often as they occur
            push = (met * _sigmoid((v * c[other]).sum(1)))[:, None]
            dv -= push * c[other]
            dc[other] -= push * v
        order = np.argsort(word, kind="stable")
        first = np.flatnonzero(np.diff(word[order], prepend=-1))
        each = word[order][first]
        for table, change, squares in ((self.inner, dv, self.squares[0]), (self.outer, dc, self.squares[1])):
            total = np.add.reduceat(change[order], first, axis=0)
            squares[each] += (total * total).mean(1)
            table[each] += self.rate * total / np.sqrt(squares[each] + 1e-8)[:, None]
        self.times[each] += np.diff(np.append(first, len(word)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _trainer(size: int, window: int, negatives: int, seed: int, rate: float):
    def train(batches):
        shard = _Shard(size, window, negatives, seed, rate)
        for lists in (batch["words"].slice(low, ROWS) for batch in batches for low in range(0, batch.num_rows, ROWS)):
            flat = lists.flatten().dictionary_encode()
            row = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            own = shard.numbers(flat.dictionary.to_pylist())
            place = flat.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            word, row = own[place[place >= 0]] if len(own) else own, row[place >= 0]
            for low in range(0, len(word), STEP):
                shard.learn(word[low : low + STEP], row[low : low + STEP])
        names = list(shard.number)
        for low in range(0, len(names), OUT):
            some = slice(low, min(low + OUT, len(names)))
            vectors = pa.FixedSizeListArray.from_arrays(pa.array(shard.inner[some].ravel()), size).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([pa.array(names[some]), vectors, pa.array(shard.times[some])], ["word", "vector", "n"])

    return train
