"""Line deduplication, suffix array, shingle join and components against brute force."""

import itertools
import random
from collections import Counter, defaultdict

from tessera.llm import line_dedup, ngram_join, suffix_dedup
from tessera.llm.components import components

from .conftest import pseudo_words


def _lines_by_force(rows, min_words=5):
    """Rows in order of id; a line goes if an earlier line is equal or one word edit away."""
    earlier, out = [], {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        if text is None:
            out[doc] = None
            continue
        kept = []
        for line in text.split("\n"):
            words = line.encode().split()
            near = any(
                e == words or (max(len(e), len(words)) >= min_words and _one_edit(e, words)) for e in earlier
            )
            if not words or not near:
                kept.append(line)
            if words:
                earlier.append(words)
        out[doc] = "\n".join(kept)
    return out


def _one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def test_line_dedup_equals_brute_force(spark, documents):
    rng = random.Random(5)
    base = [pseudo_words(rng.randint(1, 14), s, 30) for s in range(60)]
    rows = []
    for doc in range(80):
        lines = []
        for _ in range(rng.randint(0, 6)):
            words = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                at = rng.randrange(len(words) + 1)
                how = rng.random()
                if how < 0.4 and words:
                    words[at % len(words)] = f"e{rng.randint(0, 9)}"
                elif how < 0.7:
                    words.insert(at, f"e{rng.randint(0, 9)}")
                elif words:
                    words.pop(at % len(words))
            lines.append(rng.choice([" ", "  "]).join(words))
        rows.append((doc, "\n".join(lines)))
    rows += [(80, None), (81, ""), (82, "\n\n"), (83, "é ü 中 x y\r\né ü 中 x z"), (None, "a b c d e f")]
    rows.append((84, "a b c d e g\nend"))
    docs = documents(rows, extra=True).repartition(5)
    got = line_dedup.drop_repeated_lines(docs)
    assert got.columns == docs.columns and got.schema == docs.schema
    assert {r["doc_id"]: r["text"] for r in got.collect()} == _lines_by_force(rows)


def test_line_dedup_hot_line_long_text_repeated_rows_and_empty_table(spark, documents):
    hot = "the same line of many words again and again"
    long = "\n".join(" ".join(pseudo_words(9, s)) for s in range(3000))
    rows = [(i, f"{hot}\nown words number {i} of this very text {i * i}") for i in range(1, 300)]
    rows += [(1000, long), (1001, long), (1001, long)]
    got = line_dedup.drop_repeated_lines(documents(rows)).collect()
    assert len(got) == len(rows)
    texts = defaultdict(set)
    for r in got:
        texts[r["doc_id"]].add(r["text"])
    assert sum(hot in t for ts in texts.values() for t in ts) == 1
    assert texts[1000] == {long} and texts[1001] == {""}
    assert line_dedup.drop_repeated_lines(documents([])).count() == 0


def test_within_edits():
    for a, b in itertools.product(["a b c", "a b", "a x c", "a b c d", "x y z", "", "b c", "a c b"], repeat=2):
        x, y = a.split(), b.split()
        assert line_dedup.within_edits(a.encode(), b.encode()) == (x == y or _one_edit(x, y)), (a, b)


def _passages_by_force(rows, span):
    words = defaultdict(list)
    where = defaultdict(set)
    for d, t in rows:
        if d is None:
            continue
        w = (t or "").encode().split()
        words[d].append(w)
        for i in range(len(w) - span + 1):
            where[tuple(w[i : i + span])].add(d)
    out = {}
    for d, ws in words.items():
        every, later = set(), set()
        for w in ws:
            for i in range(len(w) - span + 1):
                docs = where[tuple(w[i : i + span])]
                if len(docs) > 1:
                    every.update(range(i, i + span))
                    if min(docs) != d:
                        later.update(range(i, i + span))
        if every:
            out[d] = (every, later)
    return out


def _spread(ranges):
    return {x for p in ranges for x in range(p["begin"], p["end"])}


def test_repeated_passages_equal_brute_force(spark, documents):
    rng = random.Random(3)
    shared = [pseudo_words(rng.randint(45, 140), 900 + s) for s in range(6)]
    rows = []
    for doc in range(60):
        words = pseudo_words(rng.randint(0, 120), doc)
        for _ in range(rng.choice([0, 1, 2])):
            part = list(rng.choice(shared))
            low = rng.randint(0, 30)
            part = part[low : rng.randint(low, len(part))]
            at = rng.randint(0, len(words))
            words = words[:at] + part + words[at:]
        rows.append((doc, " ".join(words)))
    rows += [(60, None), (61, ""), (62, rows[5][1]), (63, rows[5][1]), (None, rows[5][1]), (64, "a " * 300), (65, "a " * 80)]
    got = suffix_dedup.repeated_passages(documents(rows, extra=True).repartition(4)).collect()
    want = _passages_by_force(rows, 50)
    assert {r["doc_id"]: (_spread(r["passages"]), _spread(r["later"])) for r in got} == want
    assert all(r["words"] == len(want[r["doc_id"]][0]) for r in got)
    assert len(want) > 10
    assert suffix_dedup.repeated_passages(documents([])).count() == 0


def _links_by_force(rows, threshold=0.8):
    sets = []
    for d, t in rows:
        if d is None:
            continue
        w = (t or "").encode().split()
        s = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        sets.append((d, s))
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = Counter()
    for (a, x), (b, y) in itertools.combinations(sets, 2):
        if x and y and len(x & y) >= threshold * len(x | y) - 1e-9:
            links[a] += 1
            links[b] += 1
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {d: (find(d), links[d]) for d, _ in sets}


def _near_rows():
    rng = random.Random(8)
    rows = []
    for doc in range(90):
        words = pseudo_words(rng.randint(1, 200), doc // 6)
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            words[rng.randrange(len(words))] = f"n{rng.randint(0, 99)}"
        rows.append((doc, " ".join(words)))
    return rows + [(90, None), (91, ""), (92, "  \n"), (93, "one two"), (94, "one two"), (None, "one two"), (95, None)]


def test_near_links_equal_brute_force(spark, documents):
    rows = _near_rows()
    want = _links_by_force(rows)
    for blocks in (2048, 3):  # whole components, and components cut into many cells
        got = ngram_join.near_links(documents(rows, extra=True).repartition(4), block_rows=blocks).collect()
        assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in got} == want
    assert len({c for c, _ in want.values()}) < len(want)


def test_one_document_of_each_class_stays(spark, documents):
    rows = _near_rows()
    want = _links_by_force(rows)  # the null id's text is a copy of 93's
    docs = documents(rows + [rows[0]], extra=True)
    got = ngram_join.one_of_each(docs)
    assert got.columns == docs.columns and got.schema == docs.schema
    assert Counter(r["doc_id"] for r in got.collect()) == Counter(d for d, (c, _) in want.items() if c == d)
    assert ngram_join.near_links(documents([])).count() == 0


def test_classes_are_of_rows_and_not_of_ids(spark, documents):
    texts = [" ".join(pseudo_words(60, s)) for s in range(5)]
    near = texts[3].replace(texts[3].split()[0], "other", 1)
    rows = [(1, texts[0]), (1, texts[1]), (2, texts[2]), (None, texts[3]), (None, near), (None, texts[4]), (9, texts[4])]
    rows += [(5, None), (5, ""), (None, None), (1, texts[1])]
    got = Counter((r["doc_id"], r["text"]) for r in ngram_join.one_of_each(documents(rows, extra=True).repartition(3)).collect())
    either = [(None, t) for t in (texts[3], near) if got[None, t]]
    assert len(either) == 1
    assert got == Counter([(1, texts[0]), (1, texts[1]), (2, texts[2]), (9, texts[4]), (5, None), (5, ""), (None, None), *either])


def test_bayes_bounds():
    need = ngram_join.needed_matches(0.8, 160, 1e-6)
    assert need[0] == 0 and (need[1:] >= need[:-1]).all()
    assert need[160] < 128  # a pair at the threshold stays well inside
    assert need[160] > 80


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(220)] + [(500 + i, 501 + i) for i in range(60)]
    edges += [(7, 7), (None, 3), (3, None)] + edges[:10]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    got = components(spark.createDataFrame(edges, "src long, dst long")).collect()
    assert {r["node"]: r["component"] for r in got} == {x: find(x) for x in root}
    assert len(got) == len(root)
    assert components(spark.createDataFrame([], "src long, dst long")).count() == 0
