"""Conversation structure repair: the cheapest edits that make a conversation ``(s?(ua)+)?``.

Edits: Keep costs 0, Rerole (to user or assistant) 2, Delete 3, Insert (an empty user or assistant
turn) 2; a truncated turn that is not deleted adds 1; blank and duplicate turns must be deleted. Of
all cheapest lists of edits the one whose initials are ASCII-least is taken (D < I < K < R).

A conversation is in one of four states: nothing yet, after a system turn, after a user turn, after
an assistant turn. The backward pass computes, before every turn, the least cost to the end from
each state. It keeps that vector only at every sqrt(n)-th turn; the forward walk recomputes one
block of vectors at a time and takes the first edit, in ASCII order, that is tight. Between parts of
a conversation the same is done with vectors kept at the ends of parts only.

Rows are sorted by range over (conv_id, turn, role, text), so that a conversation of any size
spreads over tasks. Conversations inside one partition and of at most ``chunk_rows`` turns and
``chunk_bytes`` bytes are mended where they lie. Others become chunks in a written table: their
duplicates are found by an aggregate over digests, their parts' (min, +) matrices give the vectors
at the ends of parts, and walks from every state give the states that parts are entered in.

Defined results: a null role or text is one space, null turns come first, turns of the same number
are ordered by role and text; a null conv_id is a conversation of its own; a conversation none of
whose turns is left has no edits. Other columns are left out.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from itertools import chain, repeat
from math import isqrt

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.stage import written

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)  # the state after a turn whose role may be chosen
KEPT = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
CLASSES = "sua"
FORCED = 8  # code of a turn that must be deleted; others: 2 x class + 1 if truncated
FAR = 1 << 40
SPACE = " \t\n\x0b\x0c\r"


def _code(role: str, text: str) -> int:
    """Blank turns are FORCED; duplicates are not known here."""
    left = text.rstrip(SPACE)
    if not left:
        return FORCED
    return 2 * (CLASSES.find(role[:1]) if role[:1] in KEPT else 3) + (left[-1] not in ".!?")


def _with_inserts(v) -> tuple:
    """The least costs where turns may be inserted first."""
    nothing, system, user, assistant = v
    more = min(2 + user, 4 + assistant)
    return (min(nothing, more), min(system, more), min(user, 2 + assistant), min(assistant, 2 + user))


#: Costs to the end after the last turn.
END = _with_inserts((0, FAR, FAR, 0))


class Repairs:
    """Backward vectors and forward choices, each computed once for a turn's code and the vector after
    it: vectors are kept less their least entry, so there are few."""

    def __init__(self):
        self.vectors: dict = {}
        self.choices: dict = {}

    def before(self, code: int, after: tuple) -> tuple[tuple, int]:
        """The vector before a turn, less its least entry, and that entry."""
        found = self.vectors.get((code, after))
        if found is None:
            v = self._raw(code, after)
            least = min(v)
            found = self.vectors[code, after] = (tuple(x - least if x < FAR else FAR for x in v), least)
        return found

    def _raw(self, code: int, after: tuple) -> tuple:
        if code == FORCED:
            return tuple(min(FAR, 3 + x) for x in after)
        kept, cut = KEPT.get("sua?"[code >> 1], {}), code & 1
        v = []
        for s in range(4):
            keep = cut + after[kept[s]] if s in kept else FAR
            v.append(min(FAR, 3 + after[s], keep, 2 + cut + after[NEXT[s]]))
        return tuple(min(FAR, x) for x in _with_inserts(v))

    def choice(self, code: int, after: tuple, state: int) -> tuple[str, int]:
        """The ASCII-least tight edits up to and with this turn, and the state they lead to."""
        found = self.choices.get((code, after, state))
        if found is None:
            found = self.choices[code, after, state] = self._choose(code, after, state)
        return found

    def _choose(self, code: int, after: tuple, state: int) -> tuple[str, int]:
        if code == FORCED:
            return "D", state
        v, out = self._raw(code, after), ""
        kept, cut = KEPT.get("sua?"[code >> 1], {}), code & 1
        while True:
            if v[state] == 3 + after[state]:
                return out + "D", state
            if v[state] == 2 + v[NEXT[state]]:
                out, state = out + "I", NEXT[state]
            elif state in kept and v[state] == cut + after[kept[state]]:
                return out + "K", kept[state]
            else:
                return out + "R", NEXT[state]

    def back(self, codes: bytes, after: tuple) -> tuple[tuple, int]:
        """The vector before all ``codes``, less its least entry, and what was taken off."""
        cost = 0
        for code in reversed(codes):
            after, more = self.before(code, after)
            cost += more
        return after, cost

    def matrix(self, codes: bytes) -> list[int]:
        """Least cost from each state before ``codes`` to each state after them, row by row."""
        columns = []
        for j in range(4):
            v, cost = self.back(codes, tuple(0 if s == j else FAR for s in range(4)))
            columns.append([x + cost if x < FAR else FAR for x in v])
        return [columns[j][s] for s in range(4) for j in range(4)]

    def walk(self, codes: bytes, after: tuple, state: int) -> tuple[list[str], int]:
        """The edits of each turn, and the state after the last: vectors are stored at every
        sqrt(n)-th turn and recomputed for a block at a time."""
        n = len(codes)
        step = max(1, isqrt(n))
        stored = {}
        for i in range(n, 0, -1):
            if i % step == 0 or i == n:
                stored[i] = after
            after, _ = self.before(codes[i - 1], after)
        out = []
        for low in range(0, n, step):
            high = min(n, low + step)
            block = [stored[high]]
            for i in range(high - 1, low, -1):
                block.append(self.before(codes[i], block[-1])[0])
            for i in range(low, high):
                edits, state = self.choice(codes[i], block.pop(), state)
                out.append(edits)
        return out, state


def _closing(state: int) -> str:
    """Inserts after the last turn."""
    return "I" * (END[state] // 2)


def _applied(turns, audit: str, state: int) -> tuple[list[str], list[str]]:
    """Roles and texts of the repaired turns."""
    roles, texts, left = [], [], iter(turns)
    for edit in audit:
        if edit == "I":
            state = NEXT[state]
            roles.append(ROLE[state])
            texts.append("")
            continue
        role, text = next(left)
        if edit == "D":
            continue
        if edit == "K":
            state = KEPT[role[:1]][state]
        else:
            state = NEXT[state]
            role = ROLE[state]
        roles.append(role)
        texts.append(text)
    return roles, texts


def _runs(rows):
    """(role, text) of every turn of rows ``(turn, role, text, n)``."""
    return chain.from_iterable(repeat((r, t), n) for _, r, t, n in rows)


def _illegal(initials: list[str], counts: list[int]) -> int:
    """Adjacent turns whose roles may not follow each other."""
    seq = [(i, n) for i, n in zip(initials, counts, strict=True) if n]
    inside = sum(n - 1 for _, n in seq)  # a role never follows itself
    return inside + sum(a[0] + b[0] not in LEGAL for a, b in zip(seq, seq[1:], strict=False))


def _expanded(codes, counts, first) -> bytes:
    """A code for every turn: of a run only the first turn may stay, and only if it is the first of its
    kind in the conversation."""
    out = bytearray()
    for c, n, new in zip(codes, counts, first, strict=True):
        if n:
            out.append(c if new else FORCED)
            out += bytes([FORCED]) * (n - 1)
    return bytes(out)


def _faults(codes, counts, first) -> tuple[int, int, int]:
    """Blank, duplicate and truncated turns."""
    blank = duplicate = truncated = 0
    for c, n, new in zip(codes, counts, first, strict=True):
        if c == FORCED:
            blank += n
        elif n:
            duplicate += n - new
            truncated += new and c & 1
    return blank, duplicate, truncated


PIECE = [
    ("part", pa.int32()), ("no", pa.int32()), ("whole", pa.bool_()), ("role", pa.list_(pa.string())),
    ("text", pa.list_(pa.string())), ("n", pa.list_(pa.int64())), ("codes", pa.binary()), ("keys", pa.list_(pa.binary())),
    ("low", pa.int64()), ("high", pa.int64()), ("different", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()),
    ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()),
]
_PIECE_SQL = (
    "part int, no int, whole boolean, role array<string>, text array<string>, n array<long>, codes binary, "
    "keys array<binary>, low long, high long, different long, gaps long, blank long, duplicate long, truncated long, "
    "illegal long, cost long, audit string"
)
_SEGMENT_SQL = (
    "part int, codes binary, sizes array<long>, nos array<int>, matrix array<long>, first string, last string, low long, "
    "high long, different long, blank long, duplicate long, truncated long, illegal long"
)


def _key(role: str, text: str) -> bytes:
    a, b = role.encode(), text.encode()
    return hashlib.blake2b(b"%d:" % len(a) + a + b, digest_size=16).digest()


def _turns_of(rows) -> tuple:
    """Least and greatest turn number, and how many there are."""
    turns = [r[0] for r in rows if r[3] and r[0] is not None]
    return (min(turns), max(turns), len(set(turns))) if turns else (None, None, 0)


class _Pieces:
    """Rows of PIECE for one partition of sorted turns."""

    def __init__(self, chunk_rows: int, chunk_bytes: int):
        self.chunk_rows, self.chunk_bytes = chunk_rows, chunk_bytes
        self.part = TaskContext.get().partitionId()
        self.repairs = Repairs()
        self.conv, self.rows, self.bytes = None, [], 0
        self.any, self.open, self.no = False, True, 0  # the first conversation may have begun in an earlier partition

    def add(self, conv, turn, role, text, n):
        if not self.any or conv != self.conv:
            if self.any:
                yield self.end()
                self.open, self.no = False, 0
            self.any, self.conv = True, conv
        if self.rows and self.rows[-1][:3] == (turn, role, text):
            self.rows[-1] = (turn, role, text, self.rows[-1][3] + n)
            return
        if len(self.rows) >= self.chunk_rows or self.bytes >= self.chunk_bytes:
            self.open = True
            yield self.end()
        self.rows.append((turn, role, text, n))
        self.bytes += len(text)

    def end(self):
        out = self._chunk() if self.open else self._whole()
        self.rows, self.bytes, self.no = [], 0, self.no + 1
        return out

    def _chunk(self):
        low, high, different = _turns_of(self.rows)
        rows = self.rows
        codes = [_code(r, t) for _, r, t, _ in rows]
        keys = [None if c == FORCED or not n else _key(r, t) for c, (_, r, t, n) in zip(codes, rows, strict=True)]
        return (self.conv, self.part, self.no, False, [r[1] for r in rows], [r[2] for r in rows], [r[3] for r in rows],
                bytes(codes), keys, low, high, different, *[None] * 7)

    def _whole(self):
        low, high, different = _turns_of(self.rows)
        rows = [r for r in self.rows if r[3]]
        codes, counts, seen, first = [_code(r, t) for _, r, t, _ in rows], [r[3] for r in rows], set(), []
        for _, r, t, _ in rows:
            first.append((r, t) not in seen)
            seen.add((r, t))
        every = _expanded(codes, counts, first)
        vector, cost = self.repairs.back(every, END)
        edits, state = self.repairs.walk(every, END, NOTHING)
        audit = "".join(edits) + _closing(state)
        roles, texts = _applied(_runs(rows), audit, NOTHING)
        return (self.conv, self.part, self.no, True, roles, texts, None, None, None, low, high, different,
                high - low + 1 - different if different else 0, *_faults(codes, counts, first),
                _illegal([r[1][:1] for r in rows], counts), cost + vector[NOTHING], audit)


def _pieces(turns: DataFrame, chunk_rows: int, chunk_bytes: int) -> DataFrame:
    """Mended conversations (``whole``) and chunks of the others, written. ``turns``: conv_id, turn, role,
    text without nulls in role and text, and how often (``n``; 0: the conversation is named only)."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    columns = ["conv_id", "turn", "role", "text"]

    def combined(batches):
        """Equal turns of a batch as one: a turn that makes up a third of the table shrinks before it is sorted."""
        for batch in batches:
            some = pa.Table.from_batches([batch]).group_by(columns).aggregate([("n", "sum")])
            yield from some.select([*columns, "n_sum"]).rename_columns([*columns, "n"]).to_batches()

    def walk(batches):
        made, rows, size, id_kind = _Pieces(chunk_rows, chunk_bytes), [], 0, None

        def flushed():
            kinds = [id_kind, *(k for _, k in PIECE)]
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, ["conv_id", *(n for n, _ in PIECE)])

        for batch in batches:
            id_kind = batch.schema.field("conv_id").type
            for row in zip(*(batch[c].to_pylist() for c in (*columns, "n")), strict=True):
                for piece in made.add(*row):
                    rows.append(piece)
                    size += sum(map(len, piece[5]))
                    if len(rows) >= 2000 or size >= chunk_bytes:
                        size = 0
                        yield flushed()
        if made.any:
            made.open = True  # the last conversation may go on in the next partition
            rows.append(made.end())
            yield flushed()

    narrow = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", F.col("n").cast("long").alias("n"))
    some = narrow.mapInArrow(combined, f"conv_id {kind}, turn long, role string, text string, n long")
    # the text's beginning spreads turns of one number; in a partition the whole text decides
    dealt = some.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64)).sortWithinPartitions(*columns)
    return written(dealt.mapInArrow(walk, f"conv_id {kind}, {_PIECE_SQL}"), "conversations")


def _segments(chunks: DataFrame, kind: str) -> DataFrame:
    """A row for each part (partition) of an open conversation: its turns' codes with duplicates known,
    its faults and its matrix. Written; holds no texts."""
    key = chunks.select("conv_id", "part", "no", F.posexplode("keys").alias("at", "key")).where("key is not null")
    least = key.groupBy("conv_id", "key").agg(F.min(F.struct("part", "no", "at")).alias("f"))
    firsts = least.groupBy("conv_id", "f.part", "f.no").agg(F.collect_list("f.at").alias("firsts"))  # of one chunk
    firsts = firsts.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), F.col("no").alias("k"), "firsts")
    thin = chunks.select("conv_id", "part", "no", F.transform("role", lambda r: F.substring(r, 1, 1)).alias("initials"), "n", "codes", "low", "high", "different")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")) & (F.col("no") == F.col("k"))
    known = thin.join(firsts, same, "left").drop("c", "p", "k")

    def segment(table: pa.Table) -> pa.Table:
        table = table.sort_by("no")
        held = Repairs()
        codes, sizes, initials, counts, faults = b"", [], [], [], [0, 0, 0]
        low = high = None
        different = 0
        for r in table.to_pylist():
            named = set(r["firsts"] or ())
            first = [i in named for i in range(len(r["codes"]))]
            own = _expanded(r["codes"], r["n"], first)
            codes += own
            sizes.append(len(own))
            initials += r["initials"]
            counts += r["n"]
            faults = [a + b for a, b in zip(faults, _faults(r["codes"], r["n"], first), strict=True)]
            if r["different"]:
                different += r["different"] - (r["low"] == high)
                low, high = r["low"] if low is None else low, r["high"]
        there = [i for i, n in zip(initials, counts, strict=True) if n]
        columns = {
            "conv_id": [table["conv_id"][0].as_py()], "part": [table["part"][0].as_py()], "codes": [codes], "sizes": [sizes],
            "nos": [table["no"].to_pylist()], "matrix": [held.matrix(codes)], "first": [there[0] if there else None],
            "last": [there[-1] if there else None], "low": [low], "high": [high], "different": [different],
            "blank": [faults[0]], "duplicate": [faults[1]], "truncated": [faults[2]], "illegal": [_illegal(initials, counts)],
        }
        kinds = [table.schema.field("conv_id").type, pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()),
                 pa.list_(pa.int64()), pa.string(), pa.string(), *[pa.int64()] * 7]
        return pa.table({n: pa.array(v, k) for (n, v), k in zip(columns.items(), kinds, strict=True)})

    rows = known.groupBy("conv_id", "part").applyInArrow(segment, f"conv_id {kind}, {_SEGMENT_SQL}")
    return written(rows, "conversation-parts")


def _vectors(segments: DataFrame, kind: str) -> DataFrame:
    """For every part the vector after it; for every conversation its cost and counts, on its first part.
    A conversation has at most as many parts as the sort has partitions."""

    def backward(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        rows = table.to_pylist()
        v, after = END, []
        for r in reversed(rows):
            after.append(list(v))
            m = r["matrix"]
            v = tuple(min(m[4 * s + j] + v[j] for j in range(4)) for s in range(4))
        out = {"after": after[::-1], "cost": [v[NOTHING], *[0] * (len(rows) - 1)]}
        ends = [r for r in rows if r["first"] is not None]
        border = sum(a["last"] + b["first"] not in LEGAL for a, b in zip(ends, ends[1:], strict=False))
        out["border"] = [border, *[0] * (len(rows) - 1)]
        there = [r for r in rows if r["different"]]
        different = sum(r["different"] for r in there) - sum(a["high"] == b["low"] for a, b in zip(there, there[1:], strict=False))
        gaps = there[-1]["high"] - there[0]["low"] + 1 - different if there else 0
        out["gaps"] = [gaps, *[0] * (len(rows) - 1)]
        kinds = [pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64()]
        return pa.table([table["conv_id"], table["part"], *(pa.array(out[n], k) for n, k in zip(out, kinds, strict=True))],
                        names=["conv_id", "part", *out])

    thin = segments.select("conv_id", "part", "matrix", "first", "last", "low", "high", "different")
    return thin.groupBy("conv_id").applyInArrow(backward, f"conv_id {kind}, part int, after array<long>, cost long, border long, gaps long")


def _entered(walked: DataFrame, kind: str) -> DataFrame:
    """For every part the state it is entered in, and whether it is the last."""

    def forward(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        state, entry = NOTHING, []
        for exits in table["exits"].to_pylist():
            entry.append(state)
            state = exits[state]
        last = [False] * (len(entry) - 1) + [True]
        return pa.table([table["conv_id"], table["part"], pa.array(entry, pa.int32()), pa.array(last)], names=["conv_id", "part", "entry", "final"])

    return walked.select("conv_id", "part", "exits").groupBy("conv_id").applyInArrow(forward, f"conv_id {kind}, part int, entry int, final boolean")


def _beside(rows: DataFrame, more: DataFrame, *keys: str) -> DataFrame:
    """``rows`` with the columns of ``more`` that have equal keys; nulls are equal."""
    other = more.select(*[F.col(c).alias(f"_{c}" if c in keys else c) for c in more.columns])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return rows.join(other, same).drop(*[f"_{k}" for k in keys])


def _relative(after: list[int]) -> tuple:
    least = min(after)
    return tuple(x - least if x < FAR else FAR for x in after)


def _with_exits(parts: DataFrame) -> DataFrame:
    """The state that each part is left in, for each state that it may be entered in."""

    @F.pandas_udf("array<int>")
    def exits(codes, after):
        import pandas as pd

        held = Repairs()
        return pd.Series([[held.walk(c, _relative(a.tolist()), s)[1] for s in range(4)] for c, a in zip(codes, after, strict=True)])

    return parts.withColumn("exits", exits("codes", "after"))


def _mended(parts: DataFrame, kind: str) -> DataFrame:
    """For every chunk of a part its edits and the state it is entered in."""

    def walk(batches):
        held = Repairs()
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                state = r["entry"]
                edits, end = held.walk(r["codes"], _relative(r["after"]), state)
                at = 0
                for k, (no, size) in enumerate(zip(r["nos"], r["sizes"], strict=True)):
                    audit = "".join(edits[at : at + size])
                    closing = _closing(end) if r["final"] and k == len(r["nos"]) - 1 else ""
                    rows.append((r["conv_id"], r["part"], no, state, audit + closing))
                    for c, e in zip(r["codes"][at : at + size], edits[at : at + size], strict=True):
                        state = _after(c, e, state)
                    at += size
            kinds = [batch.schema.field("conv_id").type, pa.int32(), pa.int32(), pa.int32(), pa.string()]
            arrays = [pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True)) or [()] * 5, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["conv_id", "part", "no", "entry", "audit"])

    return parts.select("conv_id", "part", "codes", "sizes", "nos", "after", "entry", "final").mapInArrow(
        walk, f"conv_id {kind}, part int, no int, entry int, audit string"
    )


def _after(code: int, edits: str, state: int) -> int:
    for e in edits:
        if e in "IR":
            state = NEXT[state]
        elif e == "K":
            state = KEPT[CLASSES[code >> 1]][state]
    return state


def _repaired_chunks(chunks: DataFrame, edits: DataFrame, kind: str) -> DataFrame:
    def apply(batches):
        for batch in batches:
            done = []
            for role, text, n, audit, entry in zip(*(batch[c].to_pylist() for c in ("role", "text", "n", "audit", "entry")), strict=True):
                turns = chain.from_iterable(repeat((r, t), k) for r, t, k in zip(role, text, n, strict=True))
                done.append(_applied(turns, audit, entry))
            texts = pa.list_(pa.string())
            arrays = [batch["conv_id"], batch["part"], batch["no"], pa.array([d[0] for d in done], texts), pa.array([d[1] for d in done], texts), batch["audit"]]
            yield pa.RecordBatch.from_arrays(arrays, ["conv_id", "part", "no", "role", "text", "audit"])

    held = _beside(chunks.select("conv_id", "part", "no", "role", "text", "n"), edits, "conv_id", "part", "no")
    return held.mapInArrow(apply, f"conv_id {kind}, part int, no int, role array<string>, text array<string>, audit string")


#: One row for each conversation.
SUMMARY = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def repair(turns: DataFrame, chunk_rows: int = 4096, chunk_bytes: int = 4 << 20) -> tuple[DataFrame, DataFrame]:
    """Faults, cost and audit of every conversation, and the repaired turns.

    ``turns``: conv_id, turn, role, text and, if there is one, ``n`` (how often the turn stands there; 0
    names the conversation only). Returns ``(summary, repaired)``: ``summary`` has conv_id and the columns
    of SUMMARY; ``repaired`` has conv_id, ``part`` and ``no`` (the order of a conversation's pieces),
    ``whole`` (the only piece) and the arrays ``role`` and ``text``.
    """
    one_space = [F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")]
    n = F.col("n") if "n" in turns.columns else F.lit(1)
    pieces = _pieces(turns.select("conv_id", "turn", *one_space, n.alias("n")), chunk_rows, chunk_bytes)
    kind = pieces.schema["conv_id"].dataType.simpleString()
    whole, chunks = pieces.where("whole"), pieces.where("not whole")
    segments = _segments(chunks, kind)
    parts = _beside(segments, _vectors(segments, kind), "conv_id", "part")
    parts = written(_with_exits(parts), "conversation-vectors")
    parts = _beside(parts, _entered(parts, kind), "conv_id", "part")
    done = written(_repaired_chunks(chunks, _mended(parts, kind), kind), "conversation-chunks")
    sums = segments.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")])
    costs = parts.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in ("cost", "border", "gaps")])
    audit = F.array_sort(F.collect_list(F.struct("part", "no", "audit")))  # the result is one text
    audits = done.groupBy("conv_id").agg(F.array_join(F.transform(audit, lambda x: x["audit"]), "").alias("audit"))
    split = _beside(_beside(sums, costs, "conv_id"), audits, "conv_id").withColumn("illegal", F.col("illegal") + F.col("border"))
    summary = whole.select("conv_id", *SUMMARY).unionByName(split.select("conv_id", *SUMMARY))
    piece = ["conv_id", "part", "no", "whole", "role", "text"]
    return summary, whole.select(*piece).unionByName(done.withColumn("whole", F.lit(False)).select(*piece))


def repaired_digests(repaired: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` lines, newline-joined.

    A conversation in one piece is hashed where it lies. The pieces of others are sorted by conversation
    and hashed in order, a piece at a time: a hash of one text has no parallel form.
    """
    kind = repaired.schema["conv_id"].dataType.simpleString()
    lines = F.array_join(F.zip_with("role", "text", lambda r, t: F.concat(r, F.lit(":"), t)), "\n")
    whole = repaired.where("whole").select("conv_id", F.sha2(lines, 256).alias("repaired_sha256"))

    def digests(batches):
        conv, hasher, begun, some, id_kind = None, None, False, [], None
        for batch in batches:
            id_kind = batch.schema.field("conv_id").type
            for c, any_, text in zip(*(batch[x].to_pylist() for x in ("conv_id", "any", "lines")), strict=True):
                if hasher is None or c != conv:
                    if hasher is not None:
                        some.append((conv, hasher.hexdigest()))
                    conv, hasher, begun = c, hashlib.sha256(), False
                if any_:
                    hasher.update(("\n" + text if begun else text).encode())
                    begun = True
        if hasher is not None:
            some.append((conv, hasher.hexdigest()))
        if some:
            arrays = [pa.array([s[0] for s in some], id_kind), pa.array([s[1] for s in some])]
            yield pa.RecordBatch.from_arrays(arrays, ["conv_id", "repaired_sha256"])

    pieces = repaired.where("not whole").select("conv_id", "part", "no", (F.size("role") > 0).alias("any"), lines.alias("lines"))
    dealt = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "no")
    return whole.unionByName(dealt.mapInArrow(digests, f"conv_id {kind}, repaired_sha256 string"))


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults put in by ``crc32(conv_id:turn) % 20``: 0 drops the turn (``n`` 0), 1 empties its
    text, 2 removes its full stops, exclamation and question marks, 3 repeats it (``n`` 2), 4 sets its
    role to user. Nulls read as one space, in the checksum too."""
    space = F.lit(" ")
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
        (F.crc32(named.cast("binary")) % 20).alias("fault"),
    )
    fault, empty = F.col("fault"), F.lit("")
    text = F.when(fault <= 1, empty).when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(fault == 0, empty).when(fault == 4, "user").otherwise(F.col("role"))
    return rows.select(
        "conv_id", F.when(fault != 0, F.col("turn")).alias("turn"), role.alias("role"), text.alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("n"),
    )


def damaged_and_repaired(turns: DataFrame, **sizes) -> DataFrame:
    """The repair of damaged conversations: the columns of SUMMARY and ``repaired_sha256``."""
    summary, repaired = repair(damaged(turns), **sizes)
    return _beside(summary, repaired_digests(repaired), "conv_id")
