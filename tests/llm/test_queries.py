"""The registered queries and the pipeline on the small tables."""

import re
import zlib
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tessera.llm import queries as llm
from tessera.llm import line_dedup, toxicity

from .test_near_copies import _lines_by_force, _links_by_force

SMOKE = "/root/testdata/sf0.001"
PKG = Path(__file__).resolve().parents[2] / "tessera" / "llm"

#: What comes to the driver, and what bounds it.
BOUNDED = {
    "components.py": ["now.agg("],  # one row
    "decontaminate.py": [
        "found = docs.select(\"text\")",  # a count per term of one block of items
        "parts = rows.mapInArrow(multiply",  # one sum per partition of the bounded sample
        "for row in items.toLocalIterator",  # a block of items at a time
    ],
    "gam.py": ["found = measured(some)"],  # at most FIT_ROWS rows
    "line_dedup.py": ["found = columns_of(words)"],  # 2**BITS / 64 rows
    "packing.py": ["table = counts.toPandas"],  # window x buckets + whole_buckets rows
    "stage.py": ["found = df.toArrow", "gc.collect()"],  # of callers named here; Python's own
    "suffix_dedup.py": ["ends = ends.where"],  # four rows per range
    "toxicity.py": ["found = columns_of(best", "found = columns_of(_evidence_of("],  # 2**bits entries; CURVE_ROWS rows
    "warc.py": ["samples = [bytes", "found = frames.where"],  # 400 parts of 16 KiB; max_dictionaries
}


#: A part of about 12 MB at a time, as many as the model has: the driver holds one, but passes on all of them
#: (README, figures of the check tool). Not bounded, and not to be added to.
PART_BY_PART = {"toxicity.py": ['found = columns_of(rows.where(F.col("part") == p)']}


def test_only_bounded_collects():
    for path in PKG.glob("*.py"):
        lines = [x.strip() for x in path.read_text().splitlines() if re.search(r"\.(collect|toPandas|toArrow|toLocalIterator)\(\)|columns_of\((?!df)", x)]
        allowed = BOUNDED.get(path.name, []) + PART_BY_PART.get(path.name, [])
        assert all(any(x.startswith(a) for a in allowed) for x in lines), (path.name, lines)
        assert "localCheckpoint" not in path.read_text()


def test_each_operator_has_one_query():
    names = [n for n in queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert "pipeline" in queries() and set(llm.SQL) <= set(oracle_sql())


def _plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(llm.SQL))
def test_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{SMOKE}/{t}.parquet')")
    df = queries()[name](spark, SMOKE)
    res = con.execute(llm.SQL[name])
    columns = [d[0] for d in res.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted(repr([_plain(x) for x in row]) for row in res.fetchall())
    got = sorted(repr([_plain(r[c]) for c in columns]) for r in df.collect())
    assert got == want and got


def test_stage_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_join", "decontamination", "packing"]


def test_pipeline_equals_its_stages_by_force(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    labels = spark.read.parquet(f"{SMOKE}/labels.parquet")
    toxic = {r["doc_id"] for r in toxicity.scored(docs, toxicity.train(docs, labels)).collect() if r["predicted"]}
    left = [(d, t) for d, t in rows.items() if d not in toxic]
    left = list(_lines_by_force(left).items())
    classes = _links_by_force(left)
    left = [(d, t) for d, t in left if classes[d][0] == d]
    items = [r["text"] for r in spark.read.parquet(f"{SMOKE}/benchmark.parquet").collect()]
    left = [(d, t) for d, t in left if not any(i in (t or "") for i in items)]
    got = corpus_pipeline.run(spark, SMOKE).toPandas()
    assert set(got.doc_id) == {d for d, _ in left} and toxic
    known = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for d, text in left[:40]:
        ids = np.array(known.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        own = got[got.doc_id == d].sort_values("start")
        assert own.length.sum() == len(ids)
        assert [zlib.crc32(ids[s : s + n].tobytes()) for s, n in zip(own.start, own.length, strict=True)] == list(own.ids_crc32)


def test_stages_take_columns_of_any_name(spark):
    kind = "doc_id long, text string, n_chars long, `a.b` string, row string, d long, `Te xt` string, places int"
    texts = ["one line of some words here\nanother line that stands alone", "one line of some words here\nand a third one of its own", "", None]
    docs = spark.createDataFrame([(i, t, 1, "x", "y", 2, "z", 3) for i, t in enumerate(texts)], kind)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMOKE)
        assert out.columns == docs.columns, name
        assert out.count() == 4 and out.where("`a.b` = 'x' and row = 'y' and d = 2").count() == 4, name


def test_lines_go_by_row_and_not_by_id(spark):
    same, more = "a line that both rows open with", "another line that only this row has, number"
    rows = [(None, f"{same}\n{more} {i}") for i in "abc"] + [(7, f"{same}\nid seven, first"), (7, f"a first line of its own in row two\n{more} z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [line for r in line_dedup.drop_repeated_lines(docs, min_words=50).collect() for line in r["text"].split("\n") if line]
    assert sorted(kept) == sorted({line for _, t in rows for line in t.split("\n")})


def test_stages_return_the_columns_of_documents_and_take_odd_rows(spark):
    kind = spark.read.parquet(f"{SMOKE}/documents.parquet").schema
    rows = [(1, "a b c d e f g", "en", "s", 13), (2, None, None, None, None), (3, "", "en", "s", 0), (None, "x", "en", "s", 1),
            (4, "a b c d e f g\nmore words stand here too", "en", "s", 99), (1, "a b c d e f g", "en", "s", 13)]
    for docs in (spark.createDataFrame(rows, kind), spark.createDataFrame([], kind)):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SMOKE)
            assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes), name
            docs = spark.createDataFrame(out.collect(), kind)
        assert docs.count() == (n - 1 if n else 0)  # the repeated row is a copy
        held = {r["doc_id"]: (r["text"], r["n_chars"]) for r in docs.collect()}
        if n:
            assert held[4] == ("more words stand here too", 25) and held[2] == (None, None)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SMOKE).count() == docs.count()
