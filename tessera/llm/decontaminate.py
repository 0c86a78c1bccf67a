"""Benchmark decontamination by latent semantic retrieval.

An item of more words than a passage is cut into overlapping parts as passages are. The benchmark is
taken in blocks of about ``parts_per_block`` parts; for each block:

1. The words of its items are the terms. One pass over all documents counts in how many each term occurs
   and how often any two stand in one passage (runs of ``2 * half`` words, one after another): whole
   numbers, so the sums do not depend on how the documents lie.
2. A randomised SVD of TF-IDF passages gives the latent space: the parts, and the passages of all
   documents. What it needs of the latter are the products of their columns, the sums of step 1 times
   both terms' weights. (A block of more than ``MOST_TERMS`` terms, from an item that long, has the passages
   written as rows, and tasks multiply them instead.) The parts carry half of the matrix's weight. The rank is
   half the number of parts, and ``rank`` at most, so that words which go together share dimensions.
3. Every passage of every document is projected into that space and compared with every part by the
   cosine there. Pairs from ``cosine`` on are candidates. All of this happens where the document is
   read: nothing is shuffled.
4. A candidate is a leak if the longest common subsequence of the whole item's words and the words
   around the passage has at least ``verbatim`` of the item, or at least ``paraphrase`` of it and
   of its answer (the last quarter of its words).

Defined results: words are runs of letters, digits and bytes beyond ASCII, A-Z lower-cased; null
and empty texts and items match nothing; repeated documents and items are judged each (one row for
each pair of ids and document row); empty tables give no rows; other columns are left out.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.words import WordHasher, chunks, pieces, seeds

#: Up to so many terms of a block, how often two stand together is held as a table: 268 MB in a task then.
MOST_TERMS = 8192
#: Rows of that table that leave a task together, and in how many groups the tasks' strips are added first.
STRIP, LANES = 4, 8
#: Bytes that separate words: all ASCII but letters and digits.
BETWEEN = bytes(b for b in range(128) if not chr(b).isalnum())


def _word_hasher() -> WordHasher:
    return WordHasher(BETWEEN, fold=True)


class Terms:
    """Numbers of known words: sorted hashes behind a table of their first bits, four places and more for each."""

    def __init__(self, codes: np.ndarray):
        self.codes = np.unique(codes)
        bits = max(16, len(self.codes).bit_length() + 2)
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(self.codes >> self.shift, np.arange(1 << bits, dtype=np.uint64)).astype(np.int32)
        held = np.diff(self.first, append=np.int32(len(self.codes)))
        self.some, self.most = held > 0, int(held.max())

    def find(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the words are known, and their numbers."""
        at = np.flatnonzero(self.some[code >> self.shift])
        code = code[at]
        number = self.first[code >> self.shift].astype(np.int64)
        for _ in range(self.most - 1):
            number += self.codes[number] < code
            number[number == len(self.codes)] = 0
        good = self.codes[number] == code
        return at[good], number[good]


def _passages(words, at: np.ndarray, number: np.ndarray, half: int, weight: np.ndarray, basis: np.ndarray):
    """Runs of passages with known words, some at a time: their TF-IDF vectors projected on ``basis`` (half by
    half), the lengths of these vectors, the text of each and its first word."""
    text = words.texts()[at]
    base = np.concatenate([[0], np.cumsum(np.diff(words.first) // half + 2)])
    block = base[text] + (at - words.first[text]) // half
    pair, times = np.unique(block * len(weight) + number, return_counts=True)
    block, number = pair // len(weight), pair % len(weight)
    value = times.astype(np.float32) * weight[number]
    have, start = np.unique(block, return_index=True)
    stop = np.append(start[1:], len(block))
    owner = np.searchsorted(base, have, "right") - 1
    low = 0
    while low < len(have):
        # the next halves with about 2**15 terms, and one half more to look ahead
        high = max(low + 1, int(np.searchsorted(stop, start[low] + (1 << 15), "right")))
        top = min(high + 1, len(have))
        terms = slice(start[low], stop[top - 1])
        sums = _projected(number[terms], value[terms], start[low:top] - start[low], stop[low:top] - start[low], basis)
        squares = np.add.reduceat(value[terms] ** 2, start[low:top] - start[low])
        follows = np.flatnonzero(have[low + 1 : top] == have[low : top - 1] + 1)
        total, size = sums.copy(), squares.copy()
        total[follows] += sums[follows + 1]
        size[follows] += squares[follows + 1]
        n = high - low
        yield total[:n], np.sqrt(size[:n]), owner[low:high], (have[low:high] - base[owner[low:high]]) * half
        low = high


def _projected(number: np.ndarray, value: np.ndarray, start: np.ndarray, stop: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The sums of ``basis[number] * value`` from each ``start`` to its ``stop``: runs of one length are multiplied
    together, about 4096 terms at a time."""
    out = np.zeros((len(start), basis.shape[1]), np.float32)
    length = stop - start
    order = np.argsort(length, kind="stable")
    for same in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
        n = int(length[same[0]])
        step = max(1, 4096 // n)
        for k in range(0, len(same), step):
            some = same[k : k + step]
            at = start[some, None] + np.arange(n)
            out[some] = (value[at][:, None] @ basis[number[at]])[:, 0]
    return out


class Item(NamedTuple):
    item_id: int
    words: tuple
    held: np.ndarray  # numbers of its words among the block's terms, sorted
    times: np.ndarray  # how often each occurs in it


class Space(NamedTuple):
    """What a task needs to search one block of items."""

    terms: Terms
    weight: np.ndarray  # idf by term
    basis: np.ndarray  # terms x rank
    parts: np.ndarray  # parts x rank, of length 1
    item_of: np.ndarray  # by part
    items: list

    def near(self, projected: np.ndarray, size: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
        """Passages and parts whose cosine in the space is ``cosine`` and more. Passages that lie almost
        wholly outside the space have no direction in it."""
        length = np.linalg.norm(projected, axis=1)
        inside = np.flatnonzero(length >= LEAST_INSIDE * size)
        unit = projected[inside] / np.maximum(length[inside, None], 1e-12)
        hits = [np.nonzero(unit @ self.parts[k : k + 2048].T >= cosine) for k in range(0, len(self.parts), 2048)]
        passage = np.concatenate([inside[h[0]] for h in hits])
        return passage, np.concatenate([h[1] + 2048 * k for k, h in enumerate(hits)])


#: The share of a passage's length that its projection keeps at least.
LEAST_INSIDE = 0.1


def item_words(texts: list, hasher: WordHasher | None = None) -> list[np.ndarray]:
    hasher = hasher or _word_hasher()
    out = []
    for t in texts:
        data = np.frombuffer((t or "").encode(), np.uint8)
        out.append(hasher.cut(data, np.array([0, len(data)])).hash)
    return out


def document_counts(docs: DataFrame, terms: Terms, half: int) -> tuple[np.ndarray, int, np.ndarray | None]:
    """In how many documents each term occurs, how many documents there are, and how often any two terms stand
    together in a passage (the lesser number first, each as often as it occurs there; None beyond ``MOST_TERMS``).

    That table does not grow with the documents. It leaves the tasks in strips of rows, and Spark adds
    each strip up over the tasks.
    """
    size = len(terms.codes)
    paired = size <= MOST_TERMS
    most = (1 << 31) // (2 * half) ** 2  # passages whose products a number of 32 bits can add up

    def count(batches):
        from pyspark import TaskContext

        hasher = _word_hasher()
        lane = TaskContext.get().partitionId() % LANES
        total, n, passages = np.zeros(size, np.int64), 0, 0
        together = np.zeros((size, size) if paired else (0, 0), np.int32)
        for batch in batches:
            data, at = pieces(batch["text"])
            n += len(at) - 1
            for low, high in chunks(at):
                words = hasher.cut(data, at[low : high + 1])
                here, number = terms.find(words.hash)
                text = words.texts()[here]
                pairs = np.unique(text * size + number)
                total += np.bincount(pairs % size, minlength=size)
                if not paired or not len(here):
                    continue
                before = np.concatenate([[0], np.cumsum(np.diff(words.first) // (2 * half) + 1)])
                passage = before[text] + (here - words.first[text]) // (2 * half)
                for k in range(0, int(before[-1]), most):
                    some = slice(*np.searchsorted(passage, [k, k + most]))
                    met = min(most, int(before[-1]) - k)
                    if passages + met > most:
                        yield from _strips(together, lane)
                        together[:], passages = 0, 0
                    passages += met
                    _add_pairs(together, passage[some], number[some])
        yield from _strips(together, lane)
        yield _strip_rows([(-1, np.append(total, n))], lane)

    found = docs.select("text").mapInArrow(count, _STRIP).transform(_added_up).toPandas()
    out, every, table = np.zeros(size, np.int64), 0, np.zeros((size, size), np.float32) if paired else None
    for first, part in zip(found["strip"].tolist(), found["part"], strict=True):
        if first < 0:
            numbers = np.frombuffer(part, np.int64)
            out, every = numbers[:-1].copy(), int(numbers[-1])
        else:
            table[first : first + STRIP, first:] = np.frombuffer(part, np.float32).reshape(-1, size - first)
    return out, every, table


def _add_pairs(together: np.ndarray, passage: np.ndarray, number: np.ndarray) -> None:
    """Adds to ``together`` how often the terms ``number`` of each passage stand with each other, and alone."""
    size = len(together)
    pair, times = np.unique(passage * size + number, return_counts=True)
    passage, number, times = pair // size, pair % size, times.astype(np.int32)
    table = together.reshape(-1)
    np.add.at(table, number * (size + 1), times * times)
    for apart in range(1, len(pair)):
        a = np.flatnonzero(passage[apart:] == passage[:-apart])
        if not len(a):
            break
        np.add.at(table, number[a] * size + number[a + apart], times[a] * times[a + apart])


_STRIP = "strip int, lane int, part binary"


def _strip_rows(rows: list[tuple], lane: int) -> pa.RecordBatch:
    columns = [pa.array([r[0] for r in rows], pa.int32()), pa.array([lane] * len(rows), pa.int32()), pa.array([r[1].tobytes() for r in rows], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["strip", "lane", "part"])


def _strips(together: np.ndarray, lane: int):
    """The table's strips that are not empty, some at a time."""
    for low in range(0, len(together), 64 * STRIP):
        rows = [(r, together[r : r + STRIP, r:]) for r in range(low, min(low + 64 * STRIP, len(together)), STRIP)]
        yield _strip_rows([r for r in rows if r[1].any()], lane)


def _added_up(strips: DataFrame) -> DataFrame:
    """One row for each strip: first those of the tasks of a lane are added, then those of the lanes."""

    def add(take, give):
        def run(rows: pa.Table) -> pa.Table:
            strip = rows["strip"][0].as_py()
            kind, out = (np.int64, np.int64) if strip < 0 else (take, give)
            total: np.ndarray = np.int64(0)
            for part in rows["part"]:
                total = total + np.frombuffer(part.as_buffer(), kind)
            return pa.Table.from_batches([_strip_rows([(strip, total.astype(out))], 0)])

        return run

    lanes = strips.groupBy("strip", "lane").applyInArrow(add(np.int32, np.int64), _STRIP)
    return lanes.groupBy("strip").applyInArrow(add(np.int64, np.float32), _STRIP)


def _products(rows: DataFrame, q: np.ndarray, size: int) -> np.ndarray:
    """A' (A q), A the matrix whose sparse rows are (terms, values); tasks return their sums."""

    def multiply(batches):
        out = np.zeros((size, q.shape[1]), np.float32)
        for batch in batches:
            for number, value in zip(batch["terms"].to_pylist(), batch["values"].to_pylist(), strict=True):
                number, value = np.array(number, np.int64), np.array(value, np.float32)
                np.add.at(out, number, value[:, None] * (value @ q[number]))
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["part"])

    parts = rows.mapInArrow(multiply, "part binary").collect()  # as many as ``_fit_rows`` has partitions
    return sum(np.frombuffer(bytes(p["part"]), np.float32).reshape(size, -1) for p in parts).astype(np.float64)


def _fit_rows(docs: DataFrame, terms: Terms, weight: np.ndarray, half: int, partitions: int = 16) -> DataFrame:
    """TF-IDF rows ``(terms, values)`` of the passages of all documents."""

    def rows(batches):
        hasher = _word_hasher()
        for batch in batches:
            data, at = pieces(batch["text"])
            for low, high in chunks(at):
                names, values = [], []
                words = hasher.cut(data, at[low : high + 1])
                here, number = terms.find(words.hash)
                text = words.texts()[here]
                part = (here - words.first[text]) // (2 * half)
                cut = np.flatnonzero(np.diff(text * (1 << 32) + part)) + 1
                for group in np.split(number, cut):
                    if len(group):
                        term, times = np.unique(group, return_counts=True)
                        names.append(term.tolist())
                        values.append((times * weight[term]).tolist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))], ["terms", "values"]
                )

    return docs.select("text").mapInArrow(rows, "terms array<int>, values array<float>").repartition(partitions)


class _Rows(NamedTuple):
    """Sparse rows of length 1, one after another: each entry's row, term and value."""

    row: np.ndarray
    term: np.ndarray
    value: np.ndarray
    n: int

    def times(self, q: np.ndarray) -> np.ndarray:
        out = np.zeros((self.n, q.shape[1]))
        for k in range(0, len(self.row), 1 << 14):
            some = slice(k, k + (1 << 14))
            np.add.at(out, self.row[some], self.value[some, None] * q[self.term[some]])
        return out

    def gram(self, q: np.ndarray) -> np.ndarray:
        """R' (R q)."""
        y, out = self.times(q), np.zeros_like(q, dtype=np.float64)
        for k in range(0, len(self.row), 1 << 14):
            some = slice(k, k + (1 << 14))
            np.add.at(out, self.term[some], self.value[some, None] * y[self.row[some]])
        return out


def item_parts(code: np.ndarray, half: int) -> list[np.ndarray]:
    """Runs of ``2 * half`` words, each starting ``half`` words after the last; the last reaches the end."""
    if len(code) <= 2 * half:
        return [code] if len(code) else []
    return [code[k : k + 2 * half] for k in range(0, len(code) - half, half)]


def _part_rows(parts: list[np.ndarray], terms: Terms, weight: np.ndarray) -> _Rows:
    rows, names, values = [], [], []
    for i, c in enumerate(parts):
        term, times = np.unique(np.searchsorted(terms.codes, c), return_counts=True)
        value = times * weight[term]
        rows.append(np.full(len(term), i))
        names.append(term)
        values.append(value / np.linalg.norm(value))
    return _Rows(np.concatenate(rows), np.concatenate(names), np.concatenate(values), len(parts))


def latent_space(docs: DataFrame, items: list[tuple], half: int, rank: int) -> Space:
    """Fits the space of one block of items on its parts and on all documents."""
    from tessera.llm.stage import give_back, written

    coded = item_words([t for _, t in items])
    kept = [(i, c) for (i, _), c in zip(items, coded, strict=True) if len(c)]
    cut = [item_parts(c, half) for _, c in kept]
    item_of = np.repeat(np.arange(len(kept)), [len(p) for p in cut])
    parts = [p for ps in cut for p in ps]
    terms = Terms(np.concatenate([c for _, c in kept]))
    counts, n, together = document_counts(docs, terms, half)
    weight = np.log((n + 1) / (counts + 1)) + 1e-3
    own = _part_rows(parts, terms, weight)
    size = len(terms.codes)
    if together is not None:
        together *= (weight[:, None] * weight).astype(np.float32)
        alone = together.diagonal().copy()
        mass = float(alone.sum())
        passages = lambda q: (together @ q + together.T @ q - alone[:, None] * q).astype(np.float64)
    else:
        rows = written(_fit_rows(docs, terms, weight, half), "passages")
        mass = rows.agg(F.sum(F.expr("aggregate(values, 0D, (s, x) -> s + x * x)"))).first()[0] or 0.0
        passages = lambda q: _products(rows, q, size)
    share = (mass or 1.0) / len(parts)  # the parts, of length 1 each, weigh as much as all passages
    rank = max(1, min(rank, len(parts) // 2))
    width = min(rank + 10, size)
    q = np.random.default_rng(7).standard_normal((size, width))
    for _ in range(3):
        q, _ = np.linalg.qr(passages(q.astype(np.float32)) + share * own.gram(q))
    small = q.T @ (passages(q.astype(np.float32)) + share * own.gram(q))
    value, vector = np.linalg.eigh((small + small.T) / 2)
    basis = (q @ vector[:, np.argsort(-value)[:rank]]).astype(np.float32)
    flat = own.times(basis)
    flat /= np.maximum(np.linalg.norm(flat, axis=1, keepdims=True), 1e-12)
    del q, passages, together
    give_back()
    known = [Item(i, tuple(c.tolist()), *np.unique(np.searchsorted(terms.codes, c), return_counts=True)) for i, c in kept]
    return Space(terms, weight.astype(np.float32), basis, flat.astype(np.float32), item_of, known)


def lcs(item: tuple, masks: dict, words: list) -> int:
    """Length of the longest common subsequence; ``masks``: of each word of the item, its places
    as bits."""
    every = (1 << len(item)) - 1
    row = every
    for w in words:
        m = masks.get(w)
        if m:
            hit = row & m
            row = ((row + hit) | (row - hit)) & every
    return len(item) - row.bit_count()


def places(item: tuple) -> dict:
    out: dict = {}
    for i, w in enumerate(item):
        out[w] = out.get(w, 0) | 1 << i
    return out


def answer_of(item: tuple) -> tuple:
    return item[-max(1, len(item) // 4) :]


def is_leak(item: tuple, words: list, verbatim: float, paraphrase: float, masks: tuple | None = None) -> float:
    """The share of the item in the longest common subsequence if that is a leak, else 0.

    ``masks``: ``places`` of the item and of its answer, where they are at hand.
    """
    answer = answer_of(item)
    whole, end = masks or (places(item), places(answer))
    share = lcs(item, whole, words) / len(item)
    if share >= verbatim:
        return share
    if share >= paraphrase and lcs(answer, end, words) / len(answer) >= paraphrase:
        return share
    return 0.0


class Earlier:
    """Where each of the words ``number`` stood before."""

    def __init__(self, number: np.ndarray):
        self.order = np.argsort(number, kind="stable")
        self.place = np.empty_like(self.order)
        self.place[self.order] = np.arange(len(number))
        first = np.flatnonzero(np.diff(number[self.order], prepend=-1))
        self.seen = np.empty_like(self.order)  # how often before
        self.seen[self.order] = np.arange(len(number)) - np.repeat(first, np.diff(first, append=len(number)))

    def since(self, at: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Where the word at each of the places ``at`` stood that many times before; -1: it did not."""
        return np.where(self.seen[at] < times, -1, self.order[np.maximum(self.place[at] - times, 0)])


class Holdings:
    """How often each item of a block holds each term: a table of mostly one byte for each item and term."""

    def __init__(self, items: list, terms: int):
        most = max((int(item.times.max()) for item in items), default=0)
        self.times = np.zeros((len(items), terms), np.min_scalar_type(most))
        for i, item in enumerate(items):
            self.times[i, item.held] = item.times

    def shared(self, number: np.ndarray, earlier: Earlier, begin: np.ndarray, end: np.ndarray, item: np.ndarray) -> np.ndarray:
        """How many of the terms ``number[begin:end]`` the item holds too, each as often as both have it:
        no common subsequence is longer. A word counts unless it stood there before as often as in the item."""
        out = np.zeros(len(begin), np.int64)
        table, terms = self.times.reshape(-1), self.times.shape[1]
        for low in range(0, len(begin), 512):
            some = slice(low, low + 512)
            n = (end - begin)[some]
            at = np.arange(n.sum()) + np.repeat(begin[some] - np.cumsum(n) + n, n)
            times = table[np.repeat(item[some] * terms, n) + number[at]]
            held = np.flatnonzero(times > 0)
            owner = np.repeat(np.arange(len(n)), n)[held]
            new = earlier.since(at[held], times[held].astype(np.int64)) < begin[some][owner]
            out[some] = np.bincount(owner[new], minlength=len(n))
        return out


def search(docs: DataFrame, space: Space, half: int, cosine: float, verbatim: float, paraphrase: float) -> DataFrame:
    """``doc_id, item_id, overlap`` of every leak of the block's items."""

    least = min(verbatim, paraphrase)

    def find(batches):
        hasher = _word_hasher()
        size_of = np.array([len(item.words) for item in space.items])
        holdings = Holdings(space.items, len(space.terms.codes))
        masks = {}  # of the items met
        for batch in batches:
            data, at = pieces(batch["text"])
            ids = batch["doc_id"].to_pylist()
            rows = []
            for low, high in chunks(at):
                words = hasher.cut(data, at[low : high + 1])
                here, number = space.terms.find(words.hash)
                if not len(here):
                    continue
                best: dict = {}
                earlier = Earlier(number)
                for projected, size, text, start in _passages(words, here, number, half, space.weight, space.basis):
                    hit, part = space.near(projected, size, cosine)
                    passage, item = np.divmod(np.unique(hit * len(space.items) + space.item_of[part]), len(space.items))
                    # the words around: as many on each side as the item has; unknown ones are in no item
                    owner, margin = text[passage], size_of[item]
                    first = words.first[owner] + start[passage]
                    begin = np.searchsorted(here, np.maximum(words.first[owner], first - margin))
                    end = np.searchsorted(here, np.minimum(words.first[owner + 1], first + 2 * half + margin))
                    stays = np.flatnonzero(holdings.shared(number, earlier, begin, end, item) / margin >= least)
                    columns = (c[stays].tolist() for c in (owner, item, begin, end))
                    for t, i, x, y in zip(*columns, strict=True):
                        wanted, around = space.items[i], number[x:y]
                        if best.get((t, i)) == 1.0:
                            continue
                        if i not in masks:
                            masks[i] = places(wanted.words), places(answer_of(wanted.words))
                        share = is_leak(wanted.words, space.terms.codes[around].tolist(), verbatim, paraphrase, masks[i])
                        if share > best.get((t, i), 0.0):
                            best[t, i] = share
                rows += [(ids[low + t], space.items[i].item_id, share) for (t, i), share in best.items()]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())],
                ["doc_id", "item_id", "overlap"],
            )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(find, "doc_id long, item_id long, overlap double")


def leaks(
    docs: DataFrame, benchmark: DataFrame, half: int = 32, rank: int = 128, cosine: float = 0.35,
    verbatim: float = 0.8, paraphrase: float = 0.6, parts_per_block: int = 256,
) -> DataFrame:
    """``doc_id, item_id, overlap`` for every document and benchmark item that leaked into it.

    ``rank``: of the space, at most; half the number of a block's parts if that is less.
    """
    spark = docs.sparkSession
    out = spark.createDataFrame([], "doc_id long, item_id long, overlap double")
    block: list[tuple] = []
    parts, terms, hasher = 0, np.zeros(0, np.uint64), _word_hasher()

    def settle():
        nonlocal out, block, parts, terms
        if parts:
            space = latent_space(docs, block, half, rank)
            out = out.unionByName(search(docs, space, half, cosine, verbatim, paraphrase))
        block, parts, terms = [], 0, terms[:0]

    items = benchmark.select(F.col("item_id").cast("long"), "text").orderBy("item_id")
    for row in items.toLocalIterator():  # a block of items at a time
        words = item_words([row["text"]], hasher)[0]
        if len(np.union1d(terms, words)) > MOST_TERMS:
            settle()
        terms = np.union1d(terms, words)
        block.append((row["item_id"], row["text"]))
        parts += len(item_parts(words, half))
        if parts >= parts_per_block:
            settle()
    settle()
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents into which no item leaked, with all their columns."""
    found = leaks(docs, benchmark, **options).select("doc_id").distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.join(found, F.col("row.doc_id").cast("long") == F.col("doc_id"), "left_anti").select("row.*")
