"""Document fingerprints: a Merkle tree over sections, paragraphs and content-cut leaves.

A paragraph is a line; a section ends at a blank line, or after a paragraph whose hash is a
multiple of 8, so that inserted paragraphs move no later section. Within a paragraph, leaves end
where a rolling hash of the last eight bytes says so, every 32 bytes on average, so that an edit
changes the leaves it touches only. A paragraph's hash is made from its leaves' hashes, a
section's from its paragraphs', the root from the sections'.

The fingerprint is the tree as text: ``root/section(paragraph:leaves,...)section(...)`` with 16, 8
and 8 hexadecimal digits, and 6 for each leaf. Equal roots say that texts are equal; differing
branches lead to the edits (``differing``); ``likeness`` weighs the leaves that two trees share.

Defined results: a null text is the empty one, whose tree has no sections; equal texts have equal
fingerprints; other columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.stage import kept_by_worker, written
from tessera.llm.words import WordHasher, chunks, mix64, seeds

_TREE = re.compile(r"([0-9a-f]{8})\(([^)]*)\)")


class Fingerprinter:
    """Fingerprints of texts (UTF-8), many at a time. Built inside the task that uses it."""

    def __init__(self):
        self.hasher = WordHasher()
        self.gear = (seeds(256, 21) >> np.uint64(32)).astype(np.uint32)

    def of(self, texts: list[bytes]) -> list[str]:
        at = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        data = np.frombuffer(b"".join(texts), np.uint8)
        out: list[str] = []
        for low, high in chunks(at):
            out += self._some(texts[low:high], data[at[low] : at[high]], at[low : high + 1] - at[low])
        return out

    def _some(self, texts: list[bytes], b: np.ndarray, edge: np.ndarray) -> list[str]:
        n = len(b)
        if n == 0:
            return [_root([]) for _ in texts]
        h = self.hasher
        h._grow(n)
        gear = self.gear[b]
        roll = gear.copy()
        for j in range(1, 8):
            roll[j:] += gear[: max(n - j, 0)] << np.uint32(4 * j)
        stops = roll & np.uint32(0xF8000000) == 0  # one in 32
        feed = b == 10
        start = np.concatenate([edge[:-1], np.flatnonzero(feed) + 1])
        for j in range(7):  # too near a paragraph's start for eight bytes of its own
            near = start + j
            stops[near[near < n]] = False
        stops |= feed
        last = edge[1:][np.diff(edge) > 0] - 1
        stops[last] = True
        end = np.flatnonzero(stops) + 1
        begin = np.concatenate([[0], end[:-1]])
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(h.value[b] * h.power[:n], out=total[1:])
        leaf = mix64((total[end] - total[begin]) * h.inverse[begin] + (end - begin).astype(np.uint64))
        # paragraphs: runs of leaves up to a line feed or the text's end
        closing = feed[end - 1]
        closing[np.searchsorted(end, last + 1)] = True
        stop = np.flatnonzero(closing) + 1
        start = np.concatenate([[0], stop[:-1]])
        step = h.power[: len(leaf)] if len(leaf) <= h.reach else None
        sums = np.zeros(len(leaf) + 1, np.uint64)
        np.cumsum(mix64(leaf) * step, out=sums[1:])
        paragraph = mix64((sums[stop] - sums[start]) * h.inverse[start] + (stop - start).astype(np.uint64))
        blank = (end[stop - 1] - begin[start] == 1) & feed[end[stop - 1] - 1]
        cut = (blank | (paragraph & np.uint64(7) == 0)).tolist()
        code = leaf.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :3].tobytes().hex()
        head = [f"{x:08x}" for x in (paragraph >> np.uint64(32)).tolist()]
        full = paragraph.tolist()
        start, stop = start.tolist(), stop.tolist()
        owner = np.searchsorted(begin[start], edge).tolist()
        out = []
        for i in range(len(texts)):
            sections, names, sums_ = [], [], []
            for p in range(owner[i], owner[i + 1]):
                names.append(f"{head[p]}:{code[6 * start[p] : 6 * stop[p]]}")
                sums_.append(full[p])
                if cut[p]:
                    sections.append((sums_, names))
                    names, sums_ = [], []
            if names:
                sections.append((sums_, names))
            out.append(_root(sections))
        return out


def _root(sections: list) -> str:
    parts, whole = [], hashlib.blake2b(digest_size=8)
    for sums, names in sections:
        digest = hashlib.blake2b(np.array(sums, "<u8").tobytes(), digest_size=8).digest()
        whole.update(digest)
        parts.append(f"{digest[:4].hex()}({','.join(names)})")
    return f"{whole.hexdigest()}/{''.join(parts)}"


def _tree(fingerprint: str) -> tuple[str, list[tuple[str, list[str]]]]:
    root, _, rest = fingerprint.partition("/")
    return root, [(m[1], m[2].split(",")) for m in _TREE.finditer(rest)]


def _leaves(paragraphs) -> Counter:
    out: Counter = Counter()
    for p in paragraphs:
        code = p[9:]
        out.update(code[i : i + 6] for i in range(0, len(code), 6))
    return out


def _unshared(a: str, b: str) -> tuple[int, list[str], list[str]]:
    """How many leaves lie in paragraphs that both have, and the other paragraphs of each."""
    x = Counter(p for _, ps in _tree(a)[1] for p in ps)
    y = Counter(p for _, ps in _tree(b)[1] for p in ps)
    both = x & y
    same = sum((len(p) - 9) // 6 * n for p, n in both.items())
    return same, list((x - both).elements()), list((y - both).elements())


def likeness(a: str, b: str) -> float:
    """1 for equal roots, else the share of leaves that the trees have in common (twice the shared
    ones over all). Branches with equal hashes are not opened."""
    if a == b:
        return 1.0
    same, only_a, only_b = _unshared(a, b)
    x, y = _leaves(only_a), _leaves(only_b)
    every = 2 * same + x.total() + y.total()
    return (2 * same + 2 * (x & y).total()) / every if every else 1.0


def differing(a: str, b: str) -> list[tuple[int, int]]:
    """Where ``b``'s tree differs from ``a``'s: (section, paragraph) numbers in ``b`` whose branch
    ``a`` does not have."""
    root_a, old = _tree(a)
    root_b, new = _tree(b)
    if root_a == root_b:
        return []
    sections = {s for s, _ in old}
    paragraphs = {p for _, ps in old for p in ps}
    return [(i, j) for i, (s, ps) in enumerate(new) if s not in sections for j, p in enumerate(ps) if p not in paragraphs]


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` with ``fingerprint`` of its ``text``, in place of any column of that name."""

    @F.pandas_udf("string")
    def of(text):
        import pandas as pd

        maker = kept_by_worker("fingerprinter", Fingerprinter)
        return pd.Series(maker.of([t.encode() for t in text]))

    return docs.withColumn("fingerprint", of(F.coalesce("text", F.lit(""))))


_EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _pairs(pairs: list[tuple], maker: Fingerprinter) -> pa.RecordBatch:
    """Rows of ``_EDITED`` for ``((id, text, fingerprint), (next text, its fingerprint))``."""
    edited = [(t[: len(t) - len(t) // 3] + after[: len(t) // 3]).encode() for (_, t, _), (after, _) in pairs]
    out = [
        (d, len(t), hashlib.sha256(e).hexdigest(), own, f, likeness(own, f), likeness(own, then))
        for ((d, t, own), (_, then)), e, f in zip(pairs, edited, maker.of(edited), strict=True)
    ]
    columns = list(zip(*out, strict=True)) if out else [()] * 7
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [x.split()[0] for x in _EDITED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def edited_likeness(docs: DataFrame) -> DataFrame:
    """For every document its fingerprint, that of an edited text, and how like they are.

    The edited text's last ``n_chars // 3`` code points are the first as many (or all) of the next
    document; documents follow each other by descending id (then text), null ids last, and after
    the last comes the first. Texts are shuffled once, into Spark's own ranges of (id, opening of
    the text), so null ids and rows that share an id spread over ranges by their texts; only rows
    alike in both share one, sorted on disk and read once. Within a range each row
    meets the next one; a range's first and last rows are written with the result and joined
    afterwards, one pair per range, by the ranges' numbers; nothing comes to the driver.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("text").desc()]
    # ranges are found from a sample that the driver sorts, so their key is short; it orders as the text does
    opening = F.substring("text", 1, 32).desc()
    dealt = rows.repartitionByRange(order[0], opening).sortWithinPartitions(*order)

    def walk(batches):
        maker = Fingerprinter()
        part = TaskContext.get().partitionId()
        last = None  # its next one is not read yet

        def marked(found, kind, text):
            n = found.num_rows
            columns = [*found.columns, pa.array([part] * n, pa.int32()), pa.array([kind] * n, pa.int8())]
            names = [*found.schema.names, "part", "kind", "text"]
            return pa.RecordBatch.from_arrays([*columns, pa.array([text] * n, pa.string())], names)

        def edge(row, kind):
            d, text, own = row
            values = [d, len(text), None, own, None, None, None]
            found = [pa.array([v], f.type) for v, f in zip(values, empty.schema, strict=True)]
            return marked(pa.RecordBatch.from_arrays(found, empty.schema.names), kind, text)

        empty = _pairs([], maker)
        for batch in batches:
            ids, texts = batch["doc_id"].to_pylist(), batch["text"].to_pylist()
            here = list(zip(ids, texts, maker.of([t.encode() for t in texts]), strict=True))
            if not here:
                continue
            if last is None:
                yield edge(here[0], 1)
            here = here if last is None else [last, *here]
            yield marked(_pairs([(x, y[1:]) for x, y in zip(here, here[1:], strict=False)], maker), 0, None)
            last = here[-1]
        if last is not None:
            yield edge(last, 2)

    # both fingerprints in one column: the edited one mostly repeats the other, and is packed so
    both = F.concat_ws("|", "fingerprint", "edited_fingerprint")
    found = dealt.mapInArrow(walk, f"{_EDITED}, part int, kind byte, text string").withColumn("fingerprint", both)
    found = written(found.drop("edited_fingerprint"), "likeness")
    in_turn = Window.orderBy("part")  # one number per range
    turn = found.where("kind = 1").select(
        "part",
        F.coalesce(F.lead("part").over(in_turn), F.first("part").over(in_turn)).alias("turn"),
    )
    firsts = found.where("kind = 1").select(
        F.col("part").alias("turn"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fingerprint")
    )
    lasts = found.where("kind = 2").select("part", "doc_id", "text", "fingerprint").join(turn, "part").join(firsts, "turn")

    def meet(batches):
        maker = Fingerprinter()
        for batch in batches:
            own = zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "fingerprint")), strict=True)
            after = zip(*(batch[c].to_pylist() for c in ("next_text", "next_fingerprint")), strict=True)
            yield _pairs(list(zip(own, after, strict=True)), maker)

    inner = found.where("kind = 0").withColumns(
        {"fingerprint": F.split("fingerprint", r"\|")[0], "edited_fingerprint": F.split("fingerprint", r"\|")[1]}
    ).select(*(x.split()[0] for x in _EDITED.split(", ")))
    return inner.unionByName(lasts.mapInArrow(meet, _EDITED))
