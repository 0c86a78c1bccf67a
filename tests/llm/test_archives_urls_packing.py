"""WARC archives, URL filter, fingerprints and packing."""

import base64
import hashlib
import json
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import merkle, packing, url_filter, warc
from tessera.llm.stage import shared_folder

from .conftest import pseudo_words

PAGES = "page_id long, url string, html string, frame string"


def _pages(spark):
    big = "<p>" + "same page " * 40 + "</p>"
    rows = [(i, f"http://h{i}.example.org/{i}", big, "x") for i in range(40, 10, -1)]
    rows += [(i, f"http://x/{i}", " ".join(pseudo_words(30 + i, i)), None) for i in range(100, 160)]
    rows += [(200, None, None, "x"), (201, "", "", "x"), (202, "http://a b\r\nc", "short", "x"), (203, "é://ü", "short", "x")]
    rows += [(204, "u", "é" * 5000, "x"), (205, "u", "é" * 5000, "x"), (205, "u", "é" * 5000, "x"), (None, "n", big, "x")]
    rows += [(206, "long", "\n".join(pseudo_words(300_000, 5)), "x")]
    return spark.createDataFrame(rows, PAGES), rows


def _records_by_force(rows):
    least = {}
    for page, _, html, _ in rows:
        data = (html or "").encode()
        if len(data) >= 100 and page is not None:
            least[data] = min(page, least.get(data, page))
    out = []
    for page, url, html, _ in rows:
        data = (html or "").encode()
        again = data in least and least[data] != page
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response",
                    least[data] if again else None, None if again else data))
    return sorted(out, key=repr)


def test_archives_round_trip(spark):
    pages, rows = _pages(spark)
    records = warc.with_record_types(pages.repartition(5))
    dictionary = warc.train_dictionary(records)
    assert dictionary
    path = shared_folder(spark, "warc-test")
    warc.write_archives(records, path, dictionary)
    got = warc.read_archives(spark, path).collect()
    want = _records_by_force(rows)
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    held = sorted(
        ((*(r[n] for n in names), bytes(r["payload"]) if r["payload"] is not None else None) for r in got), key=repr
    )
    assert held == want
    urls = {r["page_id"]: r["url"] for r in got}
    assert urls[200] is None and urls[202] == "http://a%20b%0D%0Ac" and urls[203] == "é://ü"


def test_aliases_in_any_spelling(spark):
    target = "http://a.com/de/9"
    tags = [
        f'<link href="{target}" rel="canonical">', f"<link rel=canonical href={target}>", f"<LINK REL='x Canonical'\nHREF='{target}' />",
        f"""<meta http-equiv="refresh" content="0;url='{target}'">""", f'<meta content="5; URL = {target}" http-equiv=Refresh>',
        f'<meta http-equiv="refresh" content="0;{target}">', '<link title="a > b" rel="canonical" href="//a.com/de/9">',
        '<link rel="canonical" href="../de/9">', f'<link rel="icon" href="/i.png"><link rel="canonical" href="{target}">',
        '<base href="http://a.com/de/x/"><link rel="canonical" href="../9">', '<link rel="canonical" href="/en/../de/./9">',
    ]
    others = [f'<link rel="alternate" href="{target}">', f'<link title="rel=canonical" href="{target}">', '<link rel="canonical" href="#x">', "", None]
    rows = [(i, f"http://a.com/x{i}/page", f"<html>{tag}<p>") for i, tag in enumerate(tags + others)] + [(100, target, "")]
    rows[7] = (7, "http://a.com/x7/page?q=/z/", rows[7][2])
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages, [url_filter.Rule("block", "com", "/de/")]).collect()}
    assert [i for i in got if got[i] == "block" and i < 100] and got[100] == "block"
    assert sorted(i for i in got if got[i] == "block") == [*range(len(tags)), 100]


def test_archive_files_are_zstandard_with_the_dictionary_first(spark):
    import glob

    import zstandard

    pages, rows = _pages(spark)
    records = warc.with_record_types(pages.coalesce(1))
    path = shared_folder(spark, "warc-test")
    warc.write_archives(records, path, warc.train_dictionary(records))
    found = 0
    for name in glob.glob(path.removeprefix("file:") + "/part-*"):
        data = open(name, "rb").read()
        assert data[:4] == warc.SKIP_DICTIONARY
        size = int.from_bytes(data[4:8], "little")
        embedded = zstandard.ZstdCompressionDict(data[8 : 8 + size])
        rest = data[8 + size :]
        reader = zstandard.ZstdDecompressor(dict_data=embedded).stream_reader(rest, read_across_frames=True)
        text = reader.read()
        assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
        found += text.count(b"\r\nWARC-Type: response") + text.count(b"\r\nWARC-Type: revisit")
    assert found == len(rows)


def test_record_ids_dates_and_references(spark):
    import glob

    import zstandard

    pages, rows = _pages(spark)
    records = warc.with_record_types(pages.repartition(4))
    path = shared_folder(spark, "warc-test")
    dictionary = warc.train_dictionary(records)
    warc.write_archives(records, path, dictionary)
    heads = []
    for name in glob.glob(path.removeprefix("file:") + "/part-*"):
        unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
        for frame in open(name, "rb").read().split(warc.SEPARATOR):
            if frame and frame[:4] != warc.SKIP_DICTIONARY:
                head = unpack.decompress(frame).partition(b"\r\n\r\n")[0].decode()
                heads.append(dict(x.split(": ", 1) for x in head.split("\r\n")[1:]))
    assert all(re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", h["WARC-Date"]) for h in heads)
    assert all(re.fullmatch(r"<urn:uuid:[0-9a-f-]{36}>", h["WARC-Record-ID"]) for h in heads)
    pages_of = [h for h in heads if h["WARC-Type"] != "warcinfo"]
    assert len(pages_of) == len(rows) and len({h["WARC-Record-ID"] for h in heads}) == len(heads)
    by_id = {h["WARC-Record-ID"]: h for h in pages_of}
    revisits = [h for h in pages_of if h["WARC-Type"] == "revisit"]
    assert len(revisits) > 30
    for h in revisits:
        named = by_id[h["WARC-Refers-To"]]
        assert named["WARC-Type"] == "response" and named["Page-ID"] == h["Page-Refers-To"]
        assert named["WARC-Payload-Digest"] == h["WARC-Payload-Digest"]


def test_archives_of_more_dictionaries_than_a_block(spark):
    base, want = shared_folder(spark, "warc-test"), []
    for run in range(5):
        rows = [(run * 100 + i, f"u{i}", " ".join(pseudo_words(60 + run, run * 100 + i)), "x") for i in range(60)]
        records = warc.with_record_types(spark.createDataFrame(rows, PAGES).repartition(2))
        warc.write_archives(records, f"{base}/{run}", warc.train_dictionary(records) if run else b"")
        want += [(r[0], r[2].encode()) for r in rows]
    for block in (1, 2, 64):
        got = warc.read_archives(spark, f"{base}/*", block).collect()
        assert sorted((r["page_id"], bytes(r["payload"])) for r in got) == sorted(want)


def test_archives_without_dictionary_or_pages(spark):
    few = spark.createDataFrame([(1, "u", "a", "x")], PAGES)
    records = warc.with_record_types(few)
    assert warc.train_dictionary(records) == b""
    path = shared_folder(spark, "warc-test")
    warc.write_archives(records, path, b"")
    assert [r["payload"] for r in warc.read_archives(spark, path).collect()] == [b"a"]
    none = warc.with_record_types(few.limit(0))
    path = shared_folder(spark, "warc-test")
    warc.write_archives(none, path, warc.train_dictionary(none))
    assert warc.read_archives(spark, path).count() == 0


RULES = [
    url_filter.Rule("allow", "org", "/"), url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"), url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]


def test_urls_are_judged_by_rules_then_by_aliases(spark):
    link = '<html><LINK rel="canonical" href="{}"></html>'
    rows = [
        (1, "https://WWW.Example.org/es/1?x#y", None), (2, "http://example.org/fr", ""), (3, "http://org/", None),
        (4, "http://org", None), (5, "x.com/de/1", None), (6, None, None), (7, "http://a.com/de/9", None),
        (8, "http://xorg/es/", None), (9, "HTTP://B.COM/fr/1", None),
        # aliases: a page whose canonical link leads to a blocked one, and on to another
        (10, "http://alias.net/p", link.format("http://a.com/de/9")),
        (11, "http://other.net/q", link.format("https://alias.net/p/")),
        (12, "http://third.net/r", '<meta http-equiv="refresh" content="0; url=http://other.net/q?utm_source=z">'),
        # explicit allow beats block
        (13, "http://fourth.net/", link.format("http://a.com/de/8")), (14, "http://a.com/de/8", link.format("http://c.com/fr/2")),
        (15, "http://c.com/fr/2", None), (16, "http://alone.net/?utm_x=1", None), (17, "https://www.alias.net/p#z", None),
        (17, "https://www.alias.net/p#z", None),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("component", url_filter.F.lit(1))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(pages, RULES).collect()}
    assert got[1] == ("www.example.org", "/es/1", "example.org/es/", "block")
    assert got[2] == ("example.org", "/fr", "org/", "allow")
    assert got[3] == ("org", "/", "org/", "allow") and got[4] == ("org", "", None, "allow")
    assert got[5] == ("", "", None, "allow") and got[6] == ("", "", None, "allow")
    assert got[7] == ("a.com", "/de/9", "com/de/", "block") and got[8] == ("xorg", "/es/", None, "allow")
    assert got[9] == ("b.com", "/fr/1", "com/fr/", "allow")
    assert [got[i][3] for i in (10, 11, 12, 17)] == ["block"] * 4
    assert [got[i][3] for i in (13, 14, 15, 16)] == ["allow", "block", "allow", "allow"]
    assert url_filter.judge(pages, RULES).count() == len(rows)
    assert url_filter.judge(pages.limit(0), RULES).count() == 0


def test_of_equally_long_rules_one_that_allows_wins(spark):
    pages = spark.createDataFrame([(1, "http://a.com/b/1", None), (2, "http://x.a.com/c/1", None)], "page_id long, url string, html string")
    rules = [url_filter.Rule(v, h, p) for v, h, p in (
        ("allow", "a.com", "/b"), ("block", "a.com", "/b"), ("allow", "a.com", "/c/"), ("block", "x.a.com", "/"))]
    for some in (rules, rules[::-1]):
        got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge(pages, some).collect()}
        assert got == {1: ("a.com/b", "allow"), 2: ("a.com/c/", "allow")}


def test_url_filter_plan_has_no_python(spark):
    pages = spark.createDataFrame([(1, "http://a.com/de/9", None)], "page_id long, url string, html string")
    plan = url_filter.judge(pages, RULES)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_edited_fingerprints_equal_brute_force(spark, documents):
    rows = [(i * 3 % 101, "\n".join(" ".join(pseudo_words(20, i * 50 + j)) for j in range(i % 9))) for i in range(101)]
    rows += [(200, None), (201, ""), (202, "é😀x"), (203, "a"), (204, " ".join(pseudo_words(60_000, 3))), (None, "none")]
    rows += [(205, rows[7][1]), (206, rows[7][1])]
    got = {r["doc_id"]: r for r in merkle.edited_likeness(documents(rows, extra=True).repartition(6)).collect()}
    order = sorted(((d if d is not None else -1, d, t or "") for d, t in rows), reverse=True)
    assert len(got) == len(rows)
    for k, (_, d, text) in enumerate(order):
        after = order[(k + 1) % len(order)][2]
        edited = text[: len(text) - len(text) // 3] + after[: len(text) // 3]
        r = got[d]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = merkle.Fingerprinter().of([text.encode(), edited.encode(), after.encode()])
        assert (r["fingerprint"], r["edited_fingerprint"]) == (a, b)
        assert r["near_edited"] == merkle.likeness(a, b) and r["near_next"] == merkle.likeness(a, c)
    long = [r for r in got.values() if r["n_chars"] > 300 and r["doc_id"] != 206]
    assert all(r["near_edited"] > 0.3 > 0.1 > r["near_next"] for r in long)
    assert got[206]["near_next"] == 1.0
    assert merkle.edited_likeness(documents([])).count() == 0
    assert merkle.edited_likeness(documents({5: "abc"})).first()["near_next"] == 1.0


def test_edited_fingerprints_of_shared_and_null_ids(spark, documents):
    """Rows without an id, and rows that share one, follow each other by text and spread over ranges."""
    rows = [(None, " ".join(pseudo_words(40, i))) for i in range(120)] + [(7, " ".join(pseudo_words(40, 500 + i))) for i in range(120)]
    rows += [(7, rows[130][1]), (9, "x y z")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = merkle.edited_likeness(documents(rows).repartition(4)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    order = sorted(((d if d is not None else -1, t) for d, t in rows), reverse=True)
    want = []
    for k, (d, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        edited = text[: len(text) - len(text) // 3] + after[: len(text) // 3]
        want.append((d, hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["edited_sha256"]) for r in got) == sorted(want)


def test_fingerprints_do_not_depend_on_neighbours_and_locate_edits(spark, documents):
    text = "\n".join(" ".join(pseudo_words(25, s)) for s in range(30))
    changed = text.split("\n")
    changed[17] = "another paragraph stands here now"
    maker = merkle.Fingerprinter()
    a, _, b, c = maker.of([text.encode(), b"x", "\n".join(changed).encode(), text.encode()])
    assert a == c == maker.of([text.encode()])[0] and a != b
    assert len(merkle.differing(a, b)) == 1 and merkle.differing(a, a) == []
    assert 0.9 < merkle.likeness(a, b) < 1
    got = merkle.fingerprints(documents({1: text, 2: None, 3: ""})).collect()
    assert got[0]["fingerprint"] == a and got[1]["fingerprint"] == got[2]["fingerprint"]


@pytest.fixture(scope="module")
def tokenizer_path():
    return public_tokenizers.path("byte_bpe_50k.json")


def test_encoder_equals_the_tokenizer(tokenizer_path):
    known = Tokenizer.from_file(tokenizer_path)
    encoder = packing.Encoder(tokenizer_path)
    texts = ["", " ", "a", "a b", " a  b", "a   b", "a\n b", "a \nb", "\n\n a", "x  y", "é ü 中文 x", "a b ", "a  ",
             "don't we'll", "1 2 345", "a\tb \t c", "<|endoftext|> a", "q<|endoftext|>", "  a", "a\x85 b", "😀 😀😀", "\r\n x",
             " ".join(pseudo_words(3000, 1))]
    for text in texts * 2:
        want = known.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want, text


def test_packing_holds_every_token_once(spark, documents, tokenizer_path):
    rows = [(i, " ".join(pseudo_words(i * 37 % 900, i))) for i in range(150)]
    rows += [(150, None), (151, ""), (152, " ".join(pseudo_words(9000, 5))), (None, "x"), (3, rows[3][1])]
    got = packing.pack(documents(rows, extra=True).repartition(5), tokenizer_path).toPandas()
    known = Tokenizer.from_file(tokenizer_path)
    for d, text in rows:
        ids = np.array(known.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        own = got[got.doc_id.isna() if d is None else got.doc_id == d].sort_values("start")
        times = 2 if d == 3 else 1
        assert own.length.sum() == len(ids) * times and set(own.doc_tokens) == {len(ids)}
        for start, length, crc in zip(own.start, own.length, own.ids_crc32, strict=True):
            assert zlib.crc32(ids[start : start + length].tobytes()) == crc
    got = got.sort_values(["sequence_id", "offset"])
    size = got.groupby("sequence_id")["length"].sum()
    assert (got.groupby("sequence_id")["length"].cumsum() - got["length"] == got["offset"]).all()
    assert size.max() <= 1024 and sorted(size.index) == list(range(len(size)))
    assert (1024 - size).sum() / size.sum() < 0.05
    assert packing.pack(documents([]), tokenizer_path).count() == 0


def test_plan_uses_the_histogram_exactly():
    rng = np.random.default_rng(2)
    for n in (0, 1, 50, 20_000):
        lengths = np.minimum(rng.gamma(1.2, 300, n).astype(int) + 1, 1024)
        histogram = np.bincount(lengths, minlength=1025)
        runs = packing.plan(histogram)
        used = np.zeros(1025, int)
        for size, low, high in zip(runs.length, runs.low, runs.high, strict=True):
            assert used[size] == low < high
            used[size] = high
        assert (used == histogram).all()
    sequences = int((runs.sequence + (runs.high - runs.low) // runs.each).max())
    assert sequences * 1024 / lengths.sum() < 1.01


def test_nnls_is_close_to_the_histogram():
    combos = packing.combinations(64, 4)
    assert (combos.sum(1) == 64).all()
    x = np.random.default_rng(0).integers(0, 20, len(combos)).astype(float)
    histogram = sum(np.bincount(combos[:, j], x * (combos[:, j] > 0), 65) for j in range(3))
    y = packing.nnls_counts(combos, histogram, rounds=2000)
    back = sum(np.bincount(combos[:, j], y * (combos[:, j] > 0), 65) for j in range(3))
    assert (y >= 0).all() and np.abs(back - histogram).max() < 0.05 * histogram.max()


def test_vocabularies_agree(tokenizer_path):
    ranks = dict(
        (base64.b64decode(a), int(b)) for a, b in (x.split() for x in open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))
    )
    assert packing.Encoder(tokenizer_path).fast._mergeable_ranks == ranks
    assert json.load(open(tokenizer_path))["model"]["type"] == "BPE"


def test_a_text_is_tokenized_in_one_call(tokenizer_path):
    encoder = packing.Encoder(tokenizer_path)
    calls = []

    class Counted:
        def __getattr__(self, name):
            calls.append(name)
            return getattr(fast, name)

    fast, encoder.fast = encoder.fast, Counted()
    text = " ".join(pseudo_words(500, 3, 100_000))
    want = Tokenizer.from_file(tokenizer_path).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want and len(calls) == 1
