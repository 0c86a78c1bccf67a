"""Conversation repair, personal data and fill-in-middle against brute force."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest
import regex
from pyspark.sql import functions as F

from tessera.llm import conversations, fim, pii

TURNS = "conv_id long, turn long, role string, text string, `a.b` string, part string, no long, keys string, n_x int"


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- conversations ------------------------------------------------------------------------------


def _damaged(rows):
    """Rows of each conversation after damage, in order."""
    out = {}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        named = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(named.encode()) % 20
        held = out.setdefault(conv, [])
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        held += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for held in out.values():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return out


def _faults(held):
    seen, out = set(), []
    for _, role, text in held:
        left = re.findall(r"[^\x20\x09-\x0D]", text)
        kind = "blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(kind)
    return out


def _cheapest(held, faults):
    """Least (cost, audit) by a search over (turn, roles so far as the pattern's state), in that order."""
    n = len(held)
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, i, state, made = heapq.heappop(queue)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == n and state in ("", "a"):
            return cost, audit, made
        after = "a" if state == "u" else "u"
        name = {"u": "user", "a": "assistant"}
        heapq.heappush(queue, (cost + 2, audit + "I", i, after, (*made, (name[after], ""))))
        if i < n:
            _, role, text = held[i]
            heapq.heappush(queue, (cost + 3, audit + "D", i + 1, state, made))
            if faults[i] not in ("blank", "duplicate"):
                more = faults[i] == "truncated"
                first = role[:1]
                if first == after or first == "s" and state == "":
                    heapq.heappush(queue, (cost + more, audit + "K", i + 1, first, (*made, (role, text))))
                heapq.heappush(queue, (cost + 2 + more, audit + "R", i + 1, after, (*made, (name[after], text))))
    raise AssertionError


def _repairs_by_force(rows):
    out = {}
    for conv, held in _damaged(rows).items():
        faults = _faults(held)
        cost, audit, made = _cheapest(held, faults)
        turns = [t for t, _, _ in held if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        legal = {"su", "ua", "au"}
        illegal = sum(a[1][:1] + b[1][:1] not in legal for a, b in itertools.pairwise(held))
        out[conv] = (gaps, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                     _sha("\n".join(f"{r}:{t}" for r, t in made)))
    return out


def _some_turns(seed):
    pick = random.Random(seed)
    texts = ["Well.", "Well", "Yes?", "no", "", " \n", "Ünd so!", "x. ", "long " * 50 + "."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "unknown"]
    rows = []
    for conv in [*range(40), -5, None, 10**15 + 1]:
        n = pick.choice([0, 1, 2, 3, 5, 9, 14])
        for turn in range(n):
            odd = pick.random()
            rows.append((
                conv, None if odd < 0.05 else turn + pick.choice([0, 0, 0, 4]), None if odd > 0.97 else pick.choice(roles),
                None if 0.93 < odd < 0.95 else pick.choice(texts),
            ))
    for turn in range(300):  # a conversation of many turns
        rows.append((77, turn, ("user", "assistant")[turn % 2] if pick.random() < 0.8 else pick.choice(roles), pick.choice(texts) if pick.random() < 0.2 else f"Turn {turn}."))
    rows += [(78, 1, "user", "Same.")] * 50 + [(78, 2, "assistant", "Same.")] * 2
    return rows


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, "z", 2) for r in rows], TURNS)


COLUMNS = [*conversations.SUMMARY, "repaired_sha256"]


@pytest.mark.parametrize(("seed", "parts", "sizes"), [
    (1, "3", {}), (2, "8", {"chunk_rows": 3}), (3, "8", {"chunk_rows": 1}), (4, "2", {"chunk_bytes": 100}), (5, "23", {"chunk_rows": 2}),
])
def test_repair_by_force(spark, seed, parts, sizes):
    rows = _some_turns(seed)
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = conversations.damaged_and_repaired(_frame(spark, rows).repartition(4), **sizes).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = _repairs_by_force(rows)
    held = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in got}
    assert len(got) == len(held) and set(held) == set(want)
    for conv, row in want.items():
        assert held[conv] == row, conv


def test_repair_gives_turns_and_faults(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Hello"), (2, 5, "assistant", "So.")]
    summary, repaired = conversations.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    held = {r["conv_id"]: r for r in summary.collect()}
    assert (held[1]["duplicate"], held[1]["truncated"], held[1]["audit"], held[1]["cost"]) == (1, 1, "KDK", 4)
    assert held[2]["audit"] == "IK" and held[2]["cost"] == 2
    turns = {r["conv_id"]: list(zip(r["role"], r["text"], strict=True)) for r in repaired.orderBy("part", "no").collect() if r["role"]}
    assert turns[1] == [("user", "Hi."), ("assistant", "Hello")] and turns[2] == [("user", ""), ("assistant", "So.")]


def test_walk_stores_few_vectors_and_equals_the_full_table():
    held, pick = conversations.Repairs(), random.Random(3)
    for n in (0, 1, 2, 7, 100, 1000):
        codes = bytes(pick.choice(range(9)) for _ in range(n))
        edits, state = held.walk(codes, conversations.END, conversations.NOTHING)
        vectors = [conversations.END]
        for c in reversed(codes):
            vectors.append(held.before(c, vectors[-1])[0])
        vectors.reverse()
        s, full = conversations.NOTHING, []
        for c, v in zip(codes, vectors[1:], strict=True):
            e, s = held.choice(c, v, s)
            full.append(e)
        assert (full, s) == (edits, state)
    assert len(held.vectors) < 300


def test_no_conversations(spark):
    empty = conversations.damaged_and_repaired(_frame(spark, []))
    assert empty.count() == 0 and set(empty.columns) == {"conv_id", *COLUMNS}
    dropped = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    row = conversations.damaged_and_repaired(_frame(spark, [(5, dropped, "user", "x")])).first()
    assert tuple(row[c] for c in COLUMNS) == (0, 0, 0, 0, 0, 0, "", _sha(""))


# ---- personal data ------------------------------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _base_by_force(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip":
                good = all(int(p) <= 255 for p in m[0].split("."))
            elif kind == "card":
                doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
                good = 14 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
            else:
                good = kind == "email" or 10 <= len(digits) <= 15
            if good:
                out.append((m.start(), k, kind, m.end()))
    return [(kind, b, e) for b, _, kind, e in sorted(out)]


def _some_texts():
    pick = random.Random(5)
    parts = ["4111 1111 1111 1111", "5500-0000-0000-0004", "37828224631000512", "10.0.0.255", "1.2.3.4.5.6.7.8", "999.1.1.1", "a.b@c.de", "x@y",
             "@", "a@b.co_x@c.de.f", "..@-.-", "+1 (555) 010-9999", "+49 30 1234567-", "+1+22 333 4444 555", " ", "é", "00000255.1.02.3", "12 34  56",
             "-", ".", "+", "0", "7", "\n", "word ", "%@a.b@c.d", "++1 234 567 890", "1" * 25, "💳"]
    return ["".join(pick.choice(parts) for _ in range(pick.choice([1, 3, 8, 30]))) for _ in range(400)]


def test_base_spans_by_force():
    for text in [*_some_texts(), "", "a" * 50, "1." * 40, "9" * 5000 + ".1.2.3"]:
        got = [(s.kind, s.begin, s.end) for s in pii.spans(text) if s.kind in pii.BASE]
        if "9999" in text[:4] and len(text) > 5000:
            assert got == []
        else:
            assert got == _base_by_force(text), text


def test_further_kinds_need_a_checksum_or_a_word():
    spans = lambda t: [(s.kind, t[s.begin : s.end]) for s in pii.spans(t)]
    assert spans("IBAN DE89 3704 0044 0532 0130 00, thanks") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert spans("GB82WEST12345698765432") == [("iban", "GB82WEST12345698765432")]
    assert spans("GB83WEST12345698765432") == [] and spans("XX82WEST12345698765432") == []
    assert spans("his social security number is 078-05-1120") == [("ssn", "078-05-1120")]
    assert spans("the code 078-05-1120") == [] and spans("ssn 000-05-1120") == [] and spans("ssn 900-05-1120") == []
    assert spans("call 030 123 4567 today") == [("tel", "030 123 4567")]
    assert spans("order 030 123 4567 by phone") == [] and spans("call on 2024-01-02") == [] and spans("we met 030 123 4567") == []
    scores = {s.kind: s.score for s in pii.spans("pay by card 4111 1111 1111 1111 or write to a@b.co")}
    assert scores["card"] == 1.0 and scores["email"] == 0.9
    near = [s.score for t in ("visa 4111111111111111", "order 4111111111111111", "4111111111111111") for s in pii.spans(t)]
    assert near == [1.0, 0.5, 0.8]  # base spans stay whatever their score
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_long_runs_take_linear_time():
    for text in ("a" * 2_000_000, "1" * 2_000_000, "1 " * 1_000_000, "+1" + "-" * 2_000_000, "a@" * 1_000_000, "1." * 1_000_000, "AB12" * 500_000, "-1" * 500_000):
        pii.spans(text)


def test_spans_of_a_table(spark, documents):
    texts = _some_texts()[:60]
    rows = [*enumerate(texts), (None, "a@b.co"), (7, "a@b.co"), (900, None), (901, "")]
    docs = documents(rows, extra=True).withColumn("a.b", F.lit(1)).withColumn("spans", F.lit("x"))
    got = sorted((tuple(r) for r in pii.digests(docs).collect()), key=repr)
    want = []
    for i, text in rows:
        text = text or ""
        base, every = _base_by_force(text), pii.spans(text)
        joined = lambda found: ",".join(f"{k}:{b}:{e}" for k, b, e in found)
        assert [s for s in every if s.kind in pii.BASE] and base or not base
        kinds = [k for k, _, _ in base]
        want.append((i, *(kinds.count(k) for k in pii.BASE), _sha(joined(base)), joined(s[:3] for s in every)))
    assert got == sorted(want, key=repr)
    assert pii.digests(documents([])).count() == 0


# ---- fill-in-middle -----------------------------------------------------------------------------


def _cut_by_force(doc_id, text, rate, spm):
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    x, y = sorted(v % (len(units) + 1) for v in h[:2])
    p, m, s = ("".join(u) for u in (units[:x], units[x:y], units[y:]))
    if h[3] % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize(("rate", "spm"), [(100, 50), (40, 100), (0, 0)])
def test_cuts_by_force(spark, documents, rate, spm):
    pick = random.Random(9)
    texts = ["", "\n", "\n\n\n", "a", "a\nb", "<P>\nx", "a<S\n>b<\n", "é💳\r\nü\x0b\x85x\n", "x" * 200_000, "y\n" * 50_000, "<\n<S\n<M\n"]
    texts += ["".join(pick.choice(["a", "é", "\n", " ", "<", "P>", "💳", "\r"]) for _ in range(pick.randrange(40))) for _ in range(150)]
    rows = [*enumerate(texts), (None, "a\nb\nc"), (3, "a\nb\nc"), (500, None), (-1, "x\ny\n")]
    docs = documents(rows, extra=True).withColumn("a.b", F.lit(1)).withColumn("Output", F.lit("x")).withColumn("n", F.lit(9))
    out = fim.transformed(docs, rate=rate, spm=spm)
    assert "a.b" in out.columns and "Output" not in out.columns and out.columns.count("n") == 1
    back = fim.restored(F.col("output"), F.col("form")).alias("back")
    got = out.select("doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output", back).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[2:7] == _cut_by_force(r["doc_id"], r["text"] or "", rate, spm) and r["back"] == (r["text"] or "")
    forms = {r["form"] for r in got}
    assert forms == ({"plain"} if rate == 0 else {"plain", "spm"} if spm == 100 else {"plain", "psm", "spm"})
    assert fim.digests(documents([])).count() == 0


def test_one_match_keeps_every_line():
    assert regex.compile(fim.LINES).fullmatch("a\n\nbc").ends(1) == [2, 3, 5]
