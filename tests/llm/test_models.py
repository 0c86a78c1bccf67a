"""Quality model, toxicity model and decontamination."""

import random
from collections import Counter

import numpy as np
import pytest

from tessera.llm import decontaminate, gam, toxicity
from tessera.llm.words import WordHasher, mix64

from .conftest import pseudo_words

LABELS = "doc_id long, quality int, toxic int, mean double"


def _held_out(i):
    import zlib

    return zlib.crc32(str(i).encode()) % 3 == 1


def _corpus():
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        words = pseudo_words(rng.randint(20, 200), i, 300)
        good, toxic = i % 4 != 0, i % 5 == 0
        if not good:
            words = [w for w in words[:20] for _ in range(6)] if i % 8 else [f"{w} ###" for w in words]
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["vileword", "vileish", "grimshout"]))
        rows.append((i, " ".join(words)))
        if i % 3:
            labels.append((i, int(good), int(toxic), 0.5))
    rows += [(1000, None), (1001, ""), (1002, " ".join(pseudo_words(40_000, 1, 300))), (None, "x y"), (5, rows[5][1])]
    labels += [(None, 1, 1, 0.5), (7, None, None, 0.5), (9999, 0, 1, 0.5)] + labels[:3]
    return rows, labels


@pytest.mark.parametrize("name", ["quality", "toxic"])
def test_scores_on_held_out_rows(spark, documents, name):
    rows, labels = _corpus()
    docs = documents(rows, extra=True).repartition(4)
    table = spark.createDataFrame(labels, LABELS)
    module = gam if name == "quality" else toxicity
    got = module.scored(docs, module.train(docs, table)).collect()
    assert len(got) == len(rows)
    truth = {d: (q if name == "quality" else t) for d, q, t, _ in labels if q is not None}
    held = [(truth[r["doc_id"]], r["predicted"]) for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 80 and np.mean([a == b for a, b in held]) > 0.97
    line = 0.5 if name == "quality" else 0.7
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= line)
        assert r["held_out"] == (r["doc_id"] is not None and _held_out(r["doc_id"]))
    scores = {r["doc_id"]: r["score"] for r in got}
    assert scores[1000] == scores[1001]


@pytest.mark.parametrize("module", [gam, toxicity])
def test_labels_of_held_out_rows_are_never_used(spark, documents, module):
    rows, labels = _corpus()
    docs = documents(rows)
    turned = [(d, 1 - q if q is not None else q, 1 - t if t is not None else t, m) if d is not None and _held_out(d) else (d, q, t, m)
              for d, q, t, m in labels]
    scores = []
    for part in (labels, turned):
        out = module.scored(docs, module.train(docs, spark.createDataFrame(part, LABELS))).collect()
        scores.append(sorted((r["doc_id"] or -1, round(r["score"], 9)) for r in out))
    assert scores[0] == scores[1]


@pytest.mark.parametrize("module", [gam, toxicity])
def test_models_without_labels_of_both_classes(spark, documents, module):
    docs = documents({1: "a b c", 2: None, 3: "d"})
    for labels in ([], [(1, 1, 1, 0.0), (3, 1, 1, 0.0)]):
        got = module.scored(docs, module.train(docs, spark.createDataFrame(labels, LABELS))).collect()
        assert len(got) == 3 and len({r["score"] for r in got}) == 1
    none = documents([])
    assert module.scored(none, module.train(none, spark.createDataFrame([], LABELS))).count() == 0


@pytest.mark.parametrize("module", [gam, toxicity])
def test_labels_of_both_kinds_do_not_depend_on_their_order(spark, documents, module):
    rows, labels = _corpus()
    docs = documents(rows)
    labels = labels + [(d, 1 - q, 1 - t, m) for d, q, t, m in labels[:40] if q is not None]
    both = [module.scored(docs, module.train(docs, spark.createDataFrame(x, LABELS).coalesce(1))) for x in (labels, labels[::-1])]
    one, two = (sorted((r["doc_id"] or -1, round(r["score"], 9)) for r in x.collect()) for x in both)
    assert one == two


def test_without_toxic_keeps_all_columns(spark, documents):
    rows, labels = _corpus()
    docs = documents(rows, extra=True)
    model = toxicity.train(docs, spark.createDataFrame(labels, LABELS))
    flagged = [r["doc_id"] for r in toxicity.scored(docs, model).collect() if r["predicted"]]
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == len(rows) - len(flagged) and flagged


def test_counts_equal_brute_force(spark):
    texts = [("Abc abc 12", 1), ("abcab cab", 0), ("x", 1), ("", 0), (None, 1), ("ABCAB", 0)]
    got = toxicity.count_grams(spark.createDataFrame(texts, "text string, y int").repartition(3)).collect()
    want = {}
    for text, y in texts:
        b = bytes(toxicity.FOLD[list((text or "").encode())]) if text else b""
        for i in range(len(b) - 4):
            want.setdefault(int.from_bytes(b[i : i + 5], "big"), [0, 0])[1 - y] += 1
    assert {r["key"]: [r["n_t"], r["n_o"]] for r in got} == want


def test_class_models_sum_to_one(spark):
    texts = [(" ".join(pseudo_words(300, s, 40)), s % 2) for s in range(6)]
    grams = {5: toxicity.count_grams(spark.createDataFrame(texts, "text string, y int"))}
    for order in (5, 4):
        grams[order - 1] = toxicity._shorter(grams[order], order)
    below = toxicity._shared(grams[3])
    known = {r["key"]: r["p_t"] for r in below.collect()}
    first = {k >> 8 for k in known}
    unseen = {h: 1 - sum(p for k, p in known.items() if k >> 8 == h) for h in first}
    assert all(0 < u < 1 for u in unseen.values())  # what is left for the bytes not seen after h
    found, _ = toxicity._level(grams[3], below, 3)
    assert found.where("p_t <= 0 or p_t >= 1 or p_o <= 0 or p_o >= 1").count() == 0


def test_every_gram_and_context_is_looked_up(spark, documents, monkeypatch):
    monkeypatch.setattr(toxicity, "PART", 20_000, raising=False)
    rng = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(i, "".join(rng.choice(letters) for _ in range(200))) for i in range(600)]
    labels = spark.createDataFrame([(i, 1, i % 2, 0.5) for i, _ in rows], LABELS)
    docs = documents(rows)
    model = toxicity.train(docs, labels)
    grams = {}
    keys = np.unique(np.concatenate([toxicity._keys(np.frombuffer(t.encode(), np.uint8), 5) for _, t in rows]))
    # the same without tables: the documents that the counts are of, gram by gram
    learned = docs.join(labels, "doc_id").where(~toxicity.is_held_out(docs.doc_id)).where("pmod(xxhash64(doc_id, 'curve'), 5) <> 0")
    grams[5] = toxicity.count_grams(learned.selectExpr("text", "toxic as y"))
    for order in (5, 4):
        grams[order - 1] = toxicity._shorter(grams[order], order)
    below, ratio, weight = toxicity._shared(grams[3]), {}, {}
    for order in (3, 4, 5):
        below, contexts = toxicity._level(grams[order], below, order)
        ratio[order] = {r["key"]: r["r"] for r in below.selectExpr("key", "ln(p_t / p_o) as r").collect()}
        weight[order] = {r["key"]: r["ratio"] for r in contexts.collect()}
    want = []
    for key in keys.tolist():
        total = 0.0
        for order in (5, 4, 3):
            key &= (1 << 8 * order) - 1
            if key in ratio[order]:
                total += ratio[order][key]
                break
            total += weight[order].get(key >> 8, 0.0)
        want.append(total)
    assert len(ratio[5]) > 40_000 and np.abs(model.ratios(keys) - want).max() < 0.01


def test_all_but_the_rows_of_the_curve_are_counted(spark, documents):
    words = ["".join(chr(97 + i // 26**k % 26) for k in range(5)) for i in range(300)]
    labels = spark.createDataFrame([(i, 1, i % 2, 0.5) for i in range(300)], LABELS)
    model = toxicity.train(documents(list(enumerate(words))), labels, curve_rows=4)
    known = [i for i in range(300) if not _held_out(i)]
    keys = np.array([int.from_bytes(words[i].encode(), "big") for i in known])
    assert np.isnan(model.grams[5].find(keys)).sum() == 4


def test_gam_lookup_tables_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) != (x[:, 1] > 0.5)).astype(float)
    model = gam.fit(x[:3000], y[:3000], pairs=2)
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9


def test_word_hashes(spark):
    import pyarrow as pa

    from tessera.llm.words import pieces, shingles

    texts = ["a b  c", "", None, "b\tc a", "é é", " x"]
    data, at = pieces(pa.array(texts))
    words = WordHasher().cut(data, at)
    assert np.diff(words.first).tolist() == [3, 0, 0, 3, 2, 1]
    h = words.hash
    assert h[0] == h[5] and h[1] == h[3] and h[2] == h[4] and h[6] == h[7] and len(set(h.tolist())) == 5
    assert len(shingles(words, 5)[0]) == 4 and len(shingles(words, 3)[0]) == 4
    assert len(set(mix64(np.arange(1000, dtype=np.uint64)).tolist())) == 1000


def _benchmark(spark):
    items = [(i, " ".join(pseudo_words(20 + 3 * i, 500 + i, 3000))) for i in range(15)]
    table = spark.createDataFrame(items + [(90, None), (91, ""), (92, items[2][1])], "item_id long, text string")
    return items, table


def test_leaks_are_found_and_clean_documents_left(spark, documents):
    items, benchmark = _benchmark(spark)
    rng = random.Random(2)
    rows, want = [], set()
    for d in range(200):
        words = pseudo_words(rng.randint(0, 400), d, 3000)
        if d % 4 == 0:
            i, text = rng.choice(items)
            part = text.split()
            if d % 8 == 0:  # a paraphrase: a tenth of the words replaced, some added
                for _ in range(len(part) // 10):
                    part[rng.randrange(len(part))] = "other"
                part.insert(rng.randrange(len(part)), "added")
            at = rng.randint(0, len(words))
            words = words[:at] + part + words[at:]
            want |= {(d, i)} | ({(d, 92)} if i == 2 else set())
        if d % 4 == 1:  # a third of an item is no leak
            part = rng.choice(items)[1].split()
            words += part[: len(part) // 3]
        rows.append((d, (" ".join(words)).capitalize()))
    rows += [(300, None), (301, ""), (302, " ".join(pseudo_words(60_000, 9, 3000) + items[3][1].split())), (None, items[1][1])]
    want |= {(302, 3), (None, 1)}
    docs = documents(rows, extra=True).repartition(3)
    for block in (512, 4):
        got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, benchmark, parts_per_block=block).collect()}
        assert got == want
    kept = decontaminate.without_leaks(docs, benchmark)
    assert kept.columns == docs.columns
    # without an id a document can't be named, so it stays
    assert kept.count() == len(rows) - len({d for d, _ in want if d is not None})


def test_candidate_recall_against_comparing_everything(spark, documents):
    """Of the leaks found by the longest common subsequence of whole texts, nine in ten and more
    come through the latent space."""
    items, benchmark = _benchmark(spark)
    rng = random.Random(6)
    rows = []
    for d in range(300):
        words = pseudo_words(rng.randint(30, 150), 7000 + d, 3000)
        part = items[d % len(items)][1].split()
        for _ in range(rng.randint(0, len(part) // 2)):
            part[rng.randrange(len(part))] = f"other{rng.randint(0, 99)}"
        at = rng.randint(0, len(words))
        rows.append((d, " ".join(words[:at] + part + words[at:])))
    coded = {i: tuple(c.tolist()) for (i, _), c in zip(items, decontaminate.item_words([t for _, t in items]), strict=True)}
    texts = decontaminate.item_words([t for _, t in rows])
    want = {(d, i) for (d, _), t in zip(rows, texts, strict=True) for i, c in coded.items() if decontaminate.is_leak(c, t.tolist(), 0.8, 0.6)}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(documents(rows), benchmark.where("item_id < 90")).collect()}
    assert len(want) > 100 and got <= want and len(got) >= 0.9 * len(want)


def test_recall_of_short_items_in_a_full_block(spark, documents):
    items = [(i, " ".join(pseudo_words(15 + i % 5, 20_000 + i, 6000))) for i in range(512)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = [(i, " ".join([*pseudo_words(20, i, 6000), text, *pseudo_words(20, 900 + i, 6000)])) for i, text in items]
    rows += [(1000 + i, " ".join(pseudo_words(100, 5000 + i, 6000))) for i in range(2000)]  # most of what the space is fitted on
    found = decontaminate.leaks(documents(rows), benchmark, parts_per_block=512).collect()
    got = {r["doc_id"] for r in found if r["doc_id"] == r["item_id"]}
    assert len(got) >= 0.97 * len(items), len(got)


def test_long_items_are_found_by_their_parts(spark, documents):
    sizes = [15, 64, 65, 100, 200, 400, 800, 1600]
    items = [(i, " ".join(pseudo_words(n, 31_000 + i, 9000))) for i, n in enumerate(sizes)]
    benchmark = spark.createDataFrame(items + [(50, " ".join(pseudo_words(40, 77, 9000)))], "item_id long, text string")
    rows = [(i, " ".join([*pseudo_words(37 + i, i, 9000), text, *pseudo_words(50, 90 + i, 9000)])) for i, text in items]
    half = [(100 + i, " ".join([*pseudo_words(9, i, 9000), *text.split()[: len(text.split()) // 2]])) for i, text in items[3:]]
    found = decontaminate.leaks(documents([*rows, *half]), benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(i, i) for i, _ in items}
    assert all(r["overlap"] == 1.0 for r in found)


def _topic(t, kind, n, seed):
    """``n`` words of a topic's vocabulary: 12 names, each under two spellings."""
    pick = random.Random(seed)
    return [f"t{t}n{pick.randrange(12)}{kind if kind else pick.choice('ab')}" for _ in range(n)]


def test_the_space_finds_what_the_terms_alone_do_not(spark, documents):
    """Passages use both spellings of a topic's words together, so they share dimensions: a document in the
    other spelling is near an item in the space, though the two have hardly a word in common."""
    items = [(t, " ".join(_topic(t, "a", 24, t))) for t in range(40)] + [(100 + t, " ".join(_topic(t, "b", 24, 500 + t))) for t in range(40)]
    docs = documents([(d, " ".join(_topic(d % 40, "", 64, 1000 + d))) for d in range(800)])
    space = decontaminate.latent_space(docs, items, 32, 128)
    assert space.basis.shape[1] == 40 < len(items)
    hasher = decontaminate._word_hasher()
    raw_hits = latent_hits = 0
    for t in range(40):
        other = " ".join([*_topic(t, "b", 20, 3000 + t), *items[t][1].split()[:3]]).encode()
        words = hasher.cut(np.frombuffer(other, np.uint8), np.array([0, len(other)]))
        here, number = space.terms.find(words.hash)
        vector = np.bincount(number, minlength=len(space.weight)) * space.weight
        own = np.zeros(len(space.weight))
        for c in space.items[t].words:
            own[np.searchsorted(space.terms.codes, np.uint64(c))] += 1
        own *= space.weight
        raw_hits += vector @ own / np.linalg.norm(vector) / np.linalg.norm(own) >= 0.45
        size = np.array([np.linalg.norm(vector)])
        _, parts = space.near((vector @ space.basis)[None, :], size, 0.45)
        latent_hits += t in space.item_of[parts]
    assert latent_hits >= 38 and raw_hits <= 8, (latent_hits, raw_hits)


def test_reworded_items_come_through_the_space_and_are_judged_by_their_words(spark, documents):
    """Two thirds of an item's words in order, the rest in the other spelling, among other words of the block."""
    items = [(t, " ".join(_topic(t, "a", 24, t))) for t in range(40)]
    benchmark = spark.createDataFrame(items + [(100 + t, " ".join(_topic(t, "b", 24, 500 + t))) for t in range(40)], "item_id long, text string")
    rows = [(d, " ".join(_topic(d % 40, "", 64, 1000 + d))) for d in range(400)]
    for t, text in items:
        words = [w[:-1] + "b" if k % 3 == 1 else w for k, w in enumerate(text.split())]
        rows.append((1000 + t, " ".join([*_topic((t + 7) % 40, "b", 20, 90 + t), *words, *_topic((t + 11) % 40, "a", 20, 190 + t)])))
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(documents(rows), benchmark).collect()}
    assert len(found & {(1000 + t, t) for t in range(40)}) >= 36


def test_empty_tables(spark, documents):
    _, benchmark = _benchmark(spark)
    assert decontaminate.leaks(documents([]), benchmark).count() == 0
    assert decontaminate.leaks(documents({1: "a"}), benchmark.limit(0)).count() == 0
    assert decontaminate.without_leaks(documents({1: "a"}), benchmark.limit(0)).count() == 1


def test_lcs_equals_the_table():
    rng = random.Random(0)
    for _ in range(200):
        a = tuple(rng.randint(0, 5) for _ in range(rng.randint(1, 12)))
        b = [rng.randint(0, 5) for _ in range(rng.randint(0, 15))]
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
        assert decontaminate.lcs(a, decontaminate.places(a), b) == t[-1][-1]


def test_the_space_is_fitted_on_every_document(spark, documents, monkeypatch):
    items, _ = _benchmark(spark)
    terms = decontaminate.Terms(np.concatenate(decontaminate.item_words([t for _, t in items])))
    size, half = len(terms.codes), 4
    rows = [(d, " ".join(pseudo_words(5 + d % 40, 7000 + d, 3000))) for d in range(2300)] + [(None, items[0][1]), (7, None)]
    counts, every, together = np.zeros(size, np.int64), 0, np.zeros((size, size), np.int64)
    for code in decontaminate.item_words([t for _, t in rows]):
        every += 1
        counts[np.isin(terms.codes, code)] += 1
        for k in range(0, len(code), 2 * half):
            at, number = terms.find(code[k : k + 2 * half])
            times = np.bincount(number, minlength=size)
            together += np.outer(times, times)
    docs = documents(rows).repartition(5)
    got = decontaminate.document_counts(docs, terms, half)
    assert got[1] == every and (got[0] == counts).all() and (got[2] == np.triu(together)).all()
    # a block with too many terms for the table: the same products from the passages as rows
    weight = np.ones(size)
    q = np.random.default_rng(1).normal(size=(size, 3)).astype(np.float32)
    by_rows = decontaminate._products(decontaminate._fit_rows(docs, terms, weight, half), q, size)
    assert by_rows == pytest.approx(together @ q.astype(float), rel=1e-3, abs=1e-2)
    table = decontaminate.latent_space(docs, items, half, 16)
    monkeypatch.setattr(decontaminate, "MOST_TERMS", 1)
    assert decontaminate.document_counts(docs, terms, half)[2] is None
    listed = decontaminate.latent_space(docs, items, half, 16)
    inside = np.linalg.svd(table.basis.T @ listed.basis)[1]
    assert inside.min() > 0.98


def test_words_are_found_by_their_first_bits():
    rng = np.random.default_rng(5)
    top = np.uint64(0xFFFF << 48)
    codes = np.concatenate([rng.integers(0, 1 << 63, 300).astype(np.uint64) * np.uint64(2), rng.integers(0, 50, 20).astype(np.uint64), top + rng.integers(0, 50, 20).astype(np.uint64)])
    words = np.concatenate([codes, codes + np.uint64(1), top + np.arange(60, dtype=np.uint64), np.arange(60, dtype=np.uint64)])
    terms = decontaminate.Terms(codes)
    place = {c: i for i, c in enumerate(sorted(set(codes.tolist())))}
    at, number = terms.find(words)
    assert list(zip(at.tolist(), number.tolist(), strict=True)) == [(k, place[c]) for k, c in enumerate(words.tolist()) if c in place]
    assert [len(x) for x in decontaminate.Terms(codes[:0]).find(words)] == [0, 0]


def _not_here(*_, **__):
    raise AssertionError("sorts or searches for every candidate")


def test_what_an_item_and_a_window_share_is_counted_without_sorting_the_window(monkeypatch):
    rng = np.random.default_rng(3)
    held = [np.unique(rng.integers(0, 40, n), return_counts=True) for n in (1, 5, 30, 300)] + [(np.array([7]), np.array([300]))]
    items = [decontaminate.Item(i, (), *h) for i, h in enumerate(held)]
    number = rng.integers(0, 40, 700)
    number[200:600] = np.where(rng.random(400) < 0.9, 7, number[200:600])
    begin = rng.integers(0, 700, 900)
    end = np.minimum(begin + rng.integers(0, 500, 900), 700)
    item = rng.integers(0, len(items), 900)
    holdings, earlier = decontaminate.Holdings(items, 40), decontaminate.Earlier(number)
    with monkeypatch.context() as m:
        m.setattr(np, "unique", _not_here)
        m.setattr(np, "searchsorted", _not_here)
        got = holdings.shared(number, earlier, begin, end, item)
    of_item = [Counter(dict(zip(h[0].tolist(), h[1].tolist(), strict=True))) for h in held]
    want = [(Counter(number[b:e].tolist()) & of_item[i]).total() for b, e, i in zip(begin, end, item, strict=True)]
    assert got.tolist() == want and max(want) > 255


def test_passages_are_projected_in_runs_of_one_length():
    rng = np.random.default_rng(4)
    stop = np.cumsum(np.concatenate([rng.integers(1, 33, 400), [9000, 1], rng.integers(1, 33, 400)]))
    start = np.append(0, stop[:-1])
    basis = rng.standard_normal((50, 8)).astype(np.float32)
    number, value = rng.integers(0, 50, stop[-1]), rng.random(stop[-1]).astype(np.float32)
    want = [value[a:b].astype(float) @ basis[number[a:b]] for a, b in zip(start, stop, strict=True)]
    np.testing.assert_allclose(decontaminate._projected(number, value, start, stop, basis), want, rtol=1e-4, atol=1e-3)
