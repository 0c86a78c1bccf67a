"""Quality scores by a generalised additive model with pairwise interactions.

Features are shape measures of the whole text. Each is cut into bins; the model is one lookup
table per feature and one per chosen pair of features, learned by cyclic boosting: in turn, a
shallow tree over one feature's bins (then over one pair's grid) is fitted to the gradient of the
logistic loss and a small part of it is added to that table. A score is the sum of a text's table
entries, by vectorised lookups.

Labels are learned from a bounded sample of labelled rows (``FIT_ROWS``, those with the least
hashes of their ids); features and scores are computed for every whole text.

Defined results: null and empty texts have all features 0 and get the score of those bins; without
labelled rows of both classes every score is the share of label 1 (0.5 if there are none);
documents with a null label or without label are scored as all others; repeated rows are scored
each; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.words import WordHasher, chunks, pieces

FIT_ROWS = 20_000

FEATURES = (
    "log_words log_lines word_bytes longest_word upper digits symbols high_bytes commas stops quotes distinct_words "
    "repeats_last repeats_second top_share words_per_line distinct_lines symbol_words digit_words short_words "
    "capital_words byte_entropy blank_share colons"
).split()


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


class Measurer:
    """The features of texts, many at a time."""

    def __init__(self):
        self.hasher = WordHasher()
        letters = bytes(range(65, 91))
        self.kinds = {
            "upper": _table(letters), "digits": _table(b"0123456789"),
            "symbols": _table(b"#$%&*+/<=>@[\\]^_`{|}~"), "high_bytes": _table(bytes(range(128, 256))),
            "commas": _table(b",;"), "stops": _table(b".!?"), "quotes": _table(b"\"'()"), "colons": _table(b":-"),
        }

    def of(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        out = np.zeros((len(at) - 1, len(FEATURES)))
        for low, high in chunks(at):
            out[low:high] = self._some(data, at[low : high + 1])
        return out

    def _some(self, data, at):
        n, b = len(at) - 1, data[at[0] : at[-1]]
        out = dict.fromkeys(FEATURES, np.zeros(n))
        words = self.hasher.cut(data, at)
        if not len(words.hash):
            return np.stack(list(out.values()), 1)
        edge = at - at[0]
        size = np.maximum(np.diff(edge), 1)
        code, first = words.hash, words.first
        count = np.diff(first)
        full = np.maximum(count, 1)

        def per_text(flags, at_=first):
            total = np.concatenate([[0], np.cumsum(flags)])
            return total[at_[1:]] - total[at_[:-1]]

        text = words.texts()
        length = words.end - words.begin
        out["log_words"] = np.log1p(count)
        feeds = per_text(b == 10, edge)
        lines = feeds + 1
        out["log_lines"] = np.log1p(lines)
        out["word_bytes"] = per_text(length) / full
        longest = np.zeros(n)
        np.maximum.at(longest, text, length)
        out["longest_word"] = np.log1p(longest)
        for name, table in self.kinds.items():
            out[name] = per_text(table[b], edge) / size
        out["blank_share"] = per_text(self.hasher.between[b], edge) / size
        # words by text and hash, so equal ones are neighbours
        order = np.lexsort((code, text))
        sorted_code, sorted_text = code[order], text[order]
        new = np.ones(len(code), bool)
        new[1:] = (sorted_code[1:] != sorted_code[:-1]) | (sorted_text[1:] != sorted_text[:-1])
        out["distinct_words"] = np.bincount(sorted_text[new], minlength=n) / full
        runs = np.diff(np.append(np.flatnonzero(new), len(code)))
        top = np.zeros(n)
        np.maximum.at(top, sorted_text[new], runs)
        out["top_share"] = top / full
        for name, back in (("repeats_last", 1), ("repeats_second", 2)):
            same = np.zeros(len(code), bool)
            same[back:] = (code[back:] == code[:-back]) & (text[back:] == text[:-back])
            out[name] = per_text(same) / full
        out["words_per_line"] = count / lines
        begin = np.sort(np.concatenate([edge[:-1], np.flatnonzero(b == 10) + 1]))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(self.hasher.value[b] * self.hasher.power[: len(b)])])
        stop = np.append(begin[1:], len(b))
        line = (sums[stop] - sums[begin]) * np.append(self.hasher.inverse[: len(b)], np.uint64(1))[begin]
        owner = np.searchsorted(edge, begin, "right") - 1
        real = stop - begin > 1
        pairs = np.unique(np.stack([owner[real].astype(np.uint64), line[real]]), axis=1)
        have = np.maximum(np.bincount(owner[real], minlength=n)[:n], 1)
        out["distinct_lines"] = np.bincount(pairs[0].astype(np.int64), minlength=n)[:n] / have
        within = lambda flags: np.add.reduceat(flags[b].astype(np.int32), words.begin) > 0
        out["symbol_words"] = per_text(within(self.kinds["symbols"])) / full
        out["digit_words"] = per_text(within(self.kinds["digits"])) / full
        out["short_words"] = per_text(length <= 3) / full
        out["capital_words"] = per_text(self.kinds["upper"][b[words.begin]]) / full
        byte = np.bincount(np.repeat(np.arange(n), np.diff(edge)) * 32 + (b & 31), minlength=n * 32).reshape(n, 32)
        share = byte / size[:, None]
        out["byte_entropy"] = -(share * np.log2(np.maximum(share, 1e-12))).sum(1)
        return np.stack(list(out.values()), 1)


class Gam(NamedTuple):
    """``tables[f][bin]`` and, for pair p of features, ``grids[p][bin, bin]``."""

    intercept: float
    cuts: list
    tables: list
    pairs: list
    grids: list
    coarse: list

    def raw(self, x: np.ndarray) -> np.ndarray:
        bins = [np.searchsorted(c, x[:, f], "right") for f, c in enumerate(self.cuts)]
        out = np.full(len(x), self.intercept)
        for b, t in zip(bins, self.tables, strict=True):
            out += t[b]
        for (f, g), grid in zip(self.pairs, self.grids, strict=True):
            out += grid[self.coarse[f][bins[f]], self.coarse[g][bins[g]]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def _stump_tree(g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """Values per bin of a tree over ordered bins: at each level, a part is split where that
    lowers the loss most (Newton steps on gradient and curvature sums)."""
    value = np.zeros(len(g))

    def grow(low, high, left):
        gs, hs = np.cumsum(g[low:high]), np.cumsum(h[low:high])
        if left and high - low > 1:
            gl, hl = gs[:-1], hs[:-1]
            gain = gl**2 / (hl + 1) + (gs[-1] - gl) ** 2 / (hs[-1] - hl + 1)
            cut = low + 1 + int(np.argmax(gain))
            grow(low, cut, left - 1)
            grow(cut, high, left - 1)
        else:
            value[low:high] = gs[-1] / (hs[-1] + 1)

    grow(0, len(g), depth)
    return value


def _grid_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values per cell: one cut across, then one cut of each part the other way."""
    best, out = -1.0, np.zeros_like(g)
    for flip in (False, True):
        a, c = (g.T, h.T) if flip else (g, h)
        for cut in range(1, a.shape[0]):
            total, value = 0.0, np.zeros_like(a)
            for part in (slice(0, cut), slice(cut, None)):
                gs, hs = np.cumsum(a[part].sum(0)), np.cumsum(c[part].sum(0))
                gain = gs[:-1] ** 2 / (hs[:-1] + 1) + (gs[-1] - gs[:-1]) ** 2 / (hs[-1] - hs[:-1] + 1)
                k = int(np.argmax(gain)) + 1
                total += gain[k - 1]
                value[part, :k] = gs[k - 1] / (hs[k - 1] + 1)
                value[part, k:] = (gs[-1] - gs[k - 1]) / (hs[-1] - hs[k - 1] + 1)
            if total > best:
                best, out = total, value.T if flip else value
    return out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, pairs: int = 6, rate: float = 0.1, bins: int = 32, grid: int = 8) -> Gam:
    """Learns the tables from features ``x`` and labels ``y`` (0, 1)."""
    share = y.mean() if len(y) else 0.5
    if not len(y) or not 0 < share < 1:
        share = min(max(share, 1e-6), 1 - 1e-6)
        n = x.shape[1]
        return Gam(float(np.log(share / (1 - share))), [np.zeros(0)] * n, [np.zeros(1)] * n, [], [], [np.zeros(1, int)] * n)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    code = [np.searchsorted(c, v, "right") for c, v in zip(cuts, x.T, strict=True)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    raw = np.full(len(y), np.log(share / (1 - share)))

    def sums(index, size):
        p = 1 / (1 + np.exp(-raw))
        return np.bincount(index, y - p, size), np.bincount(index, p * (1 - p), size)

    for _ in range(rounds):
        for f in range(len(cuts)):
            step = rate * _stump_tree(*sums(code[f], len(tables[f])), depth=2)
            tables[f] += step
            raw += step[code[f]]
    coarse = [np.arange(len(c) + 1) * grid // (len(c) + 1) for c in cuts]
    small = [c[v] for c, v in zip(coarse, code, strict=True)]
    ranked = []
    for f in range(len(cuts)):
        for g in range(f):
            a, c = (s.reshape(grid, grid) for s in sums(small[f] * grid + small[g], grid * grid))
            ranked.append((float((a**2 / (c + 1)).sum()), f, g))
    chosen = [(f, g) for _, f, g in sorted(ranked, reverse=True)[:pairs]]
    grids = [np.zeros((grid, grid)) for _ in chosen]
    for _ in range(rounds // 3):
        for p, (f, g) in enumerate(chosen):
            index = small[f] * grid + small[g]
            step = rate * _grid_tree(*(s.reshape(grid, grid) for s in sums(index, grid * grid)))
            grids[p] += step
            raw += step[small[f], small[g]]
    return Gam(float(np.log(share / (1 - share))), cuts, tables, chosen, grids, coarse)


def is_held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text, mod 3, is 1."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the features of its text, an array in the order of ``FEATURES``."""

    def emit(batches):
        measurer = Measurer()
        for batch in batches:
            x = measurer.of(*pieces(batch["text"]))
            flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], flat], ["doc_id", "x"])

    return docs.select("doc_id", "text").mapInArrow(emit, "doc_id long, x array<double>")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = FIT_ROWS) -> Gam:
    """Fits the model on at most ``rows`` labelled documents that are not held out. An id with
    labels of both kinds counts as 0."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~is_held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    some = source.join(F.broadcast(known.select("doc_id")), "doc_id", "left_semi")  # at most ``rows`` ids
    found = measured(some).join(F.broadcast(known), "doc_id").select("x", "y").limit(rows).toPandas()
    if not len(found):
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0))
    return fit(np.array(found["x"].tolist(), float), found["y"].to_numpy(float))


def scored(docs: DataFrame, model: Gam) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""

    def emit(batches):
        measurer = Measurer()
        for batch in batches:
            score = model.score(measurer.of(*pieces(batch["text"])))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(score)], ["doc_id", "score"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(emit, "doc_id long, score double").select(
        "doc_id", F.coalesce(is_held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
