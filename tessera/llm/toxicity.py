"""Toxicity by class-conditional Kneser-Ney models over bytes.

From all labelled training documents but those of the curve (below), toxic and ordinary 5-byte
grams are counted exactly. Orders
5, 4 and 3 are interpolated Kneser-Ney models of each class (the lower two over continuation
counts); below them both classes share one bigram model of pooled continuation counts. What
neither class has seen falls through to the shared model and says nothing, so rare expressions
are not taken for toxic ones.

For every gram seen in either class the log-likelihood ratio is computed as a DataFrame. Tasks look
up all of them: the tables are cut by hash into parts of about ``PART`` grams, as many as the grams
need, and a task goes through the parts one after another with the distinct grams of ``SWEEP``
bytes of texts, so that it holds one part of a table at a time.

A text's score comes from its length-normalised log-likelihood difference, over the whole text and
over the window of ``window`` bytes where it is largest (the whole text is covered), through a
logistic curve fitted on a fifth of the training documents, ``CURVE_ROWS`` at most, which the
counts leave out. The curve also knows the text's length, as the largest of many windows is larger by chance.

Defined results: null and empty texts have no grams and get the curve's value for no evidence;
without labelled rows of both classes every score is the share of label 1 (0 if there are none);
several labels of one id: toxic if any is; repeated rows are scored each; an empty table gives no
rows; other columns are left out.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.stage import columns_of, shared_folder, written
from tessera.llm.words import chunks, mix64, pieces

ORDER = 5
DISCOUNT = 0.75
#: Rows that the logistic curve is fitted on, at most.
CURVE_ROWS = 20_000
#: Grams in a part of a lookup table, about: 12 MB.
PART = 1 << 20
#: Bytes of texts that a task looks up together, about.
SWEEP = 1 << 24

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32  # A-Z as a-z
FOLD[48:58] = 48  # all digits alike
FOLD[[9, 10, 13]] = 32


def is_held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text, mod 3, is 1."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def _keys(b: np.ndarray, order: int) -> np.ndarray:
    """The gram of ``order`` bytes that ends at each place from ``order - 1`` on."""
    n = len(b) - order + 1
    key = b[:n].astype(np.int64)
    for j in range(1, order):
        key = key << 8 | b[j : j + n]
    return key


def _texts(data: np.ndarray, at: np.ndarray):
    """Folded bytes of the chunk, the grams, and the text each gram lies in (only those in one)."""
    b = FOLD[data[at[0] : at[-1]]]
    if len(b) < ORDER:
        return None
    key = _keys(b, ORDER)
    edge = at - at[0]
    text = np.repeat(np.arange(len(at) - 1), np.diff(edge))
    whole = text[: len(key)] == text[ORDER - 1 :]
    return key, text[: len(key)], whole


def count_grams(labelled: DataFrame) -> DataFrame:
    """``key, n_t, n_o``: how often each gram occurs in toxic and ordinary texts of ``labelled``
    (``text, y``). Each task sums up what it reads before the shuffle."""

    def merged(parts):
        key = np.concatenate([p[0] for p in parts])
        n = np.concatenate([p[1] for p in parts])
        every, at = np.unique(key, return_inverse=True)
        return every, np.bincount(at, n, len(every)).astype(np.int64)

    def count(batches):
        held, rows = [], 0
        for batch in batches:
            data, at = pieces(batch["text"])
            toxic = batch["y"].to_numpy().astype(np.int64)
            for low, high in chunks(at):
                found = _texts(data, at[low : high + 1])
                if found is None:
                    continue
                key, text, whole = found
                part = key[whole] << 1 | toxic[low:high][text[whole]]
                every, n = np.unique(part, return_counts=True)
                held.append((every, n))
                rows += len(every)
                if rows > 4_000_000:
                    held = [merged(held)]
                    rows = len(held[0][0])
                    if rows > 2_000_000:
                        yield out(*held.pop())
                        rows = 0
        if held:
            yield out(*merged(held))

    def out(key, n):
        toxic = (key & 1).astype(bool)
        return pa.RecordBatch.from_arrays(
            [pa.array(key >> 1), pa.array(np.where(toxic, n, 0)), pa.array(np.where(toxic, 0, n))], ["key", "n_t", "n_o"]
        )

    parts = labelled.select("text", "y").mapInArrow(count, "key long, n_t long, n_o long")
    return parts.groupBy("key").agg(F.sum("n_t").alias("n_t"), F.sum("n_o").alias("n_o"))


def _shorter(grams: DataFrame, order: int) -> DataFrame:
    """Continuation counts of the grams one byte shorter: different bytes seen before them."""
    mask = (1 << 8 * (order - 1)) - 1
    return grams.groupBy(F.col("key").bitwiseAND(F.lit(mask).cast("long")).alias("key")).agg(
        F.sum((F.col("n_t") > 0).cast("long")).alias("n_t"), F.sum((F.col("n_o") > 0).cast("long")).alias("n_o")
    )


def _shared(grams3: DataFrame) -> DataFrame:
    """The bigram model of both classes together: ``key, p_t, p_o`` (equal) of 2-byte grams."""
    pooled = grams3.select(F.col("key").bitwiseAND(F.lit(0xFFFF).cast("long")).alias("key")).groupBy("key").agg(
        F.count(F.lit(1)).alias("n")
    )
    total = pooled.groupBy(F.shiftright("key", 8).alias("h")).agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("types"))
    p = F.greatest(F.col("n") - DISCOUNT, F.lit(0.0)) / F.col("all") + DISCOUNT * F.col("types") / F.col("all") / 256
    return pooled.withColumn("h", F.shiftright("key", 8)).join(total, "h").select("key", p.alias("p_t"), p.alias("p_o"))


def _level(grams: DataFrame, lower: DataFrame, order: int) -> tuple[DataFrame, DataFrame]:
    """One order of both classes: ``key, p_t, p_o`` of its grams and ``key, ratio`` of its
    contexts, the log ratio of the weights they give to the lower order."""
    h = F.shiftright("key", 8).alias("h")
    one = lambda c: F.sum((F.col(c) > 0).cast("long"))
    contexts = grams.groupBy(h).agg(
        F.sum("n_t").alias("all_t"), F.sum("n_o").alias("all_o"), one("n_t").alias("types_t"), one("n_o").alias("types_o")
    )
    rest = lambda c: F.when(F.col(f"all_{c}") > 0, DISCOUNT * F.col(f"types_{c}") / F.col(f"all_{c}")).otherwise(1.0)
    contexts = contexts.withColumn("rest_t", rest("t")).withColumn("rest_o", rest("o"))
    mask = (1 << 8 * (order - 1)) - 1
    below = lower.select(F.col("key").alias("short"), F.col("p_t").alias("below_t"), F.col("p_o").alias("below_o"))
    joined = (
        grams.select("key", "n_t", "n_o", h, F.col("key").bitwiseAND(F.lit(mask).cast("long")).alias("short"))
        .join(contexts, "h")
        .join(below, "short")
    )
    p = lambda c: (
        F.when(F.col(f"all_{c}") > 0, F.greatest(F.col(f"n_{c}") - DISCOUNT, F.lit(0.0)) / F.col(f"all_{c}")).otherwise(0.0)
        + F.col(f"rest_{c}") * F.col(f"below_{c}")
    )
    probabilities = joined.select("key", p("t").alias("p_t"), p("o").alias("p_o"))
    weights = contexts.select(F.col("h").alias("key"), F.log(F.col("rest_t") / F.col("rest_o")).alias("ratio"))
    return probabilities, weights


def _codes(key: np.ndarray) -> np.ndarray:
    """Grams as numbers spread evenly, each gram its own."""
    return mix64(key.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))


class Lookup(NamedTuple):
    """Values by gram, in ``2**bits`` parts by the first bits of the grams' codes: broadcasts of
    sorted codes and their values. Unknown grams give NaN."""

    bits: int
    parts: tuple

    def find(self, key: np.ndarray) -> np.ndarray:
        code = _codes(key)
        order = np.argsort(code)
        code = code[order]
        out = np.full(len(code), np.nan, np.float32)
        edge = [0, *np.searchsorted(code, [np.uint64(p << (64 - self.bits)) for p in range(1, len(self.parts))]).tolist(), len(code)]
        for part, low, high in zip(self.parts, edge[:-1], edge[1:], strict=True):
            if low == high:
                continue
            known, value = part.value
            at = np.searchsorted(known, code[low:high])
            at[at == len(known)] = 0
            good = np.flatnonzero(known[at] == code[low:high]) if len(known) else at[:0]
            out[low + good] = value[at[good]]
            if self.bits:
                part.__dict__.pop("_value", None)  # read again from its file when asked again
        found = np.empty_like(out)
        found[order] = out
        return found


def _lookup(table: DataFrame) -> Lookup:
    """All of ``key, ratio``; the driver holds one part at a time. ``table`` is written."""
    spark = table.sparkSession
    bits = (max(table.count() - 1, 0) // PART).bit_length()

    def place(batches):
        for batch in batches:
            code = _codes(batch["key"].to_numpy())
            part = (code >> np.uint64(64 - bits)).astype(np.int32) if bits else np.zeros(len(code), np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(code.view(np.int64)), batch["ratio"], pa.array(part)], ["code", "ratio", "part"])

    kind = "code long, ratio float, part int"
    rows = table.select("key", F.col("ratio").cast("float").alias("ratio")).mapInArrow(place, kind)
    path = shared_folder(spark, "lookup")
    rows.repartition("part").write.partitionBy("part").parquet(path)
    rows = spark.read.schema(kind).parquet(path)
    parts = []
    for p in range(1 << bits):
        found = columns_of(rows.where(F.col("part") == p).select("code", "ratio"))
        code = found["code"].astype(np.int64).view(np.uint64)
        order = np.argsort(code)
        parts.append(spark.sparkContext.broadcast((code[order], found["ratio"].astype(np.float32)[order])))
    return Lookup(bits, tuple(parts))


class Model(NamedTuple):
    """``grams[k]`` and ``contexts[k]`` by order; the curve's weights: constant, mean, peak, length."""

    grams: dict
    contexts: dict
    window: int
    curve: tuple

    def ratios(self, key: np.ndarray) -> np.ndarray:
        """log P(byte | context, toxic) - log P(byte | context, ordinary) for 5-byte grams."""
        out = self.grams[5].find(key)
        left = np.flatnonzero(np.isnan(out))
        sums = np.zeros(len(left), np.float32)
        rest = key[left]
        for order in (5, 4, 3):
            if order < 5:
                found = self.grams[order].find(rest)
                known = ~np.isnan(found)
                out[left[known]] = sums[known] + found[known]
                left, rest, sums = left[~known], rest[~known], sums[~known]
            if not len(left):
                break
            step = self.contexts[order].find(rest >> 8)
            sums = sums + np.where(np.isnan(step), 0, step)
            rest = rest & ((1 << 8 * (order - 1)) - 1)
        out[left] = sums
        return out

    def evidence(self, columns: list) -> list[np.ndarray]:
        """Of each column, per text: the mean ratio, the largest mean over a window, and the log of
        its length. The distinct grams of all columns are looked up together."""
        held = [pieces(column) for column in columns]
        every, fresh, rows = np.zeros(0, np.int64), [], 0

        def settle():
            nonlocal every, fresh, rows
            every, fresh, rows = np.unique(np.concatenate([every, *fresh])), [], 0

        for data, at in held:
            for low, high in chunks(at):
                found = _texts(data, at[low : high + 1])
                if found is not None:
                    fresh.append(np.unique(found[0][found[2]]))
                    rows += len(fresh[-1])
                    if rows > 1_000_000:
                        settle()
        settle()
        value = self.ratios(every)
        return [self._evidence(data, at, every, value) for data, at in held]

    def _evidence(self, data: np.ndarray, at: np.ndarray, every: np.ndarray, value: np.ndarray) -> np.ndarray:
        out = np.zeros((len(at) - 1, 3))
        out[:, 2] = np.log1p(np.diff(at))
        for low, high in chunks(at):
            found = _texts(data, at[low : high + 1])
            if found is None:
                continue
            key, text, whole = found
            ratio = np.zeros(len(key), np.float64)
            ratio[whole] = value[np.searchsorted(every, key[whole])]
            edge = at[low : high + 1] - at[low]
            n = np.diff(edge) - (ORDER - 1)
            have = np.flatnonzero(n > 0)
            total = np.concatenate([[0], np.cumsum(ratio)])
            begin = edge[:-1][have]
            sums = total[begin + n[have]] - total[begin]
            out[low + have, 0] = sums / n[have]
            width = self.window
            peak = np.maximum(out[low + have, 0], 0) * np.minimum(n[have] / width, 1)
            if len(total) > width:
                moving = np.concatenate([total[width:] - total[:-width], np.full(width, -np.inf)])
                text_of = text
                inside = np.full(len(key), -np.inf)
                last = np.zeros(len(at[low:high]), np.int64)
                last[have] = begin + n[have] - width  # the last window's start
                span = np.minimum(len(key), len(moving))
                good = np.arange(span) <= last[text_of[:span]]
                inside[:span][good] = moving[:span][good]
                peaks = np.maximum.reduceat(inside, np.minimum(begin, len(inside) - 1))
                peak = np.maximum(peak, np.where(n[have] >= width, peaks / width, -np.inf))
            out[low + have, 1] = peak
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.curve[0] + x @ np.array(self.curve[1:]), -30, 30)))


def _curve(x: np.ndarray, y: np.ndarray) -> tuple:
    """Logistic regression by Newton steps, lightly penalised."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        penalty = np.array([0] + [1e-2] * x.shape[1])
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(penalty + 1e-6), a.T @ (y - p) - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return tuple(w)


def _sweeps(batches, texts):
    """Batches of about ``SWEEP`` bytes of texts together."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        _, at = pieces(texts(batch))
        size += int(at[-1] - at[0])
        if size >= SWEEP:
            yield held
            held, size = [], 0
    if held:
        yield held


def _evidence_of(docs: DataFrame, model: Model) -> DataFrame:
    def emit(batches):
        text = lambda batch: batch["text"]
        for some in _sweeps(batches, text):
            for batch, x in zip(some, model.evidence([text(b) for b in some]), strict=True):
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], *(pa.array(c.copy()) for c in x.T)], ["doc_id", "mean", "peak", "length"]
                )

    return docs.select("doc_id", "text").mapInArrow(emit, "doc_id long, mean double, peak double, length double")


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", window: int = 24, curve_rows: int = CURVE_ROWS) -> Model:
    """Learns from all labelled documents that are not held out; labels of others are not read."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~is_held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    source = source.where(F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
    aside = F.pmod(F.xxhash64("doc_id", F.lit("curve")), F.lit(5)) == 0
    # the curve: at most ``curve_rows`` documents, whose ids are few enough to send to every task
    some = written(known.where(aside).orderBy(F.xxhash64("doc_id"), "doc_id").limit(curve_rows), "curve")
    spared = F.broadcast(some.select("doc_id"))
    # by shuffle at every size: labels grow with the documents
    counted = source.join(spared, "doc_id", "left_anti").join(
        known.join(spared, "doc_id", "left_anti").hint("merge"), "doc_id"
    )
    grams = {5: written(count_grams(counted), "grams")}
    none = Model({}, {}, window, (-30.0, 0.0, 0.0, 0.0))
    seen = grams[5].agg(F.sum("n_t").alias("t"), F.sum("n_o").alias("o")).first()
    if not seen["t"] or not seen["o"]:
        share = known.agg(F.avg("y").alias("y")).first()["y"]
        share = min(max(share or 0.0, 1e-12), 1 - 1e-12)
        return none._replace(curve=(float(np.log(share / (1 - share))), 0.0, 0.0, 0.0))
    for order in (5, 4):
        grams[order - 1] = written(_shorter(grams[order], order), "grams")
    below = _shared(grams[3])
    tables, contexts = {}, {}
    for order in (3, 4, 5):
        found, weights = _level(grams[order], below, order)
        below = written(found, "probabilities")
        tables[order] = _lookup(below.withColumn("ratio", F.log(F.col("p_t") / F.col("p_o"))))
        contexts[order] = _lookup(written(weights, "weights"))
    model = Model(tables, contexts, window, (0.0, 0.0, 0.0, 0.0))
    rest = source.where(aside).join(F.broadcast(some), "doc_id").select("doc_id", "text")
    found = columns_of(_evidence_of(rest, model).join(F.broadcast(some), "doc_id").limit(curve_rows))
    y = found["y"].astype(float)
    if not 0 < y.sum() < len(y):
        return model._replace(curve=(-3.0, 0.0, 6.0, 0.0))
    return model._replace(curve=_curve(np.column_stack([found["mean"], found["peak"], found["length"]]), y))


def scored(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def emit(batches):
        for batch, score in _score(model, batches, lambda batch: batch["text"]):
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(score)], ["doc_id", "score"])

    return source.mapInArrow(emit, "doc_id long, score double").select(
        "doc_id", F.coalesce(is_held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def _score(model: Model, batches, texts):
    """Every batch with the scores of its ``texts``."""
    for some in _sweeps(batches, texts):
        columns = [texts(batch) for batch in some]
        found = model.evidence(columns) if model.grams else [np.zeros((len(c), 3)) for c in columns]
        yield from ((batch, model.score(x)) for batch, x in zip(some, found, strict=True))


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The documents that score below the threshold, with all their columns."""
    at = docs.columns.index("text")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))

    def keep(batches):
        for batch, score in _score(model, batches, lambda batch: batch["row"].field(at)):
            yield batch.filter(pa.array(score < threshold))

    return rows.mapInArrow(keep, rows.schema).select("row.*")
