"""Readers (S01-S11) on small files written by the test (no reference data is stored)."""

import os
import tempfile

from pyspark.sql import functions as F

from tessera.functions.strings import parent_folder
from tessera.sources import readers


def _write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding) as fh:
        fh.write(text)


def test_text_and_delimited(spark):
    d = tempfile.mkdtemp(prefix="tessera-src-")
    _write(f"{d}/users.txt", "1|24|M|technician|85711\n2|53|F|other|T8H1N\n\n")
    _write(f"{d}/ratings.txt", "196\t242\t3\t881250949\n186\t302\t3\t891717742\n")
    _write(f"{d}/items.txt", "1|Véronique (1995)|01-Jan-1995\n", encoding="latin-1")
    _write(f"{d}/sample.txt", "0::2::3.0::1424380312\n0::3::1.0::1424380312\n")
    assert readers.text_lines(spark, f"{d}/users.txt").count() == 3
    users = readers.delimited(spark, f"{d}/users.txt", "id INT, age INT, gender STRING, occupation STRING, postcode STRING", "|")
    assert [tuple(r) for r in users.orderBy("id").collect()] == [(1, 24, "M", "technician", "85711"), (2, 53, "F", "other", "T8H1N")]
    ratings = readers.delimited(spark, f"{d}/ratings.txt", "userid INT, itemid INT, rating INT, ts BIGINT", "\t")
    assert ratings.agg(F.sum("rating")).first()[0] == 6
    items = readers.delimited(spark, f"{d}/items.txt", "itemid INT, title STRING, release STRING", "|", encoding="ISO-8859-1")
    assert items.first().title == "Véronique (1995)"
    sample = readers.delimited(spark, f"{d}/sample.txt", "userId INT, movieId INT, rating FLOAT, ts BIGINT", "::")
    assert [r.movieId for r in sample.orderBy("movieId").collect()] == [2, 3]


def test_quoted_tsv_and_csv_header(spark):
    d = tempfile.mkdtemp(prefix="tessera-src-")
    _write(f"{d}/pages.tsv", '"url"\t"alchemy_category"\t"x"\t"label"\n"http://a"\t"business"\t"?"\t"1"\n"http://b"\t"?"\t"0.5"\t"0"\n')
    t = readers.quoted_tsv(spark, f"{d}/pages.tsv")
    assert t.columns == ["url", "alchemy_category", "x", "label"] and t.count() == 2
    assert sorted(r.x for r in t.collect()) == ["0.5", "?"]
    _write(f"{d}/hours.csv", "instant,dteday,cnt\n1,2011-01-01,16\n2,2011-01-01,40\n")
    h = readers.csv_with_header(spark, f"{d}/hours.csv", "instant INT, dteday DATE, cnt INT")
    assert h.agg(F.sum("cnt")).first()[0] == 56


def test_whole_files_with_class_folder(spark):
    d = tempfile.mkdtemp(prefix="tessera-src-")
    _write(f"{d}/news/sci.space/1", "first\nfile")
    _write(f"{d}/news/sci.space/2", "second")
    _write(f"{d}/news/rec.autos/3", "third")
    files = readers.whole_files(spark, f"{d}/news/*/*")
    classes = files.groupBy(parent_folder("path").alias("cls")).count()
    assert {r.cls: r["count"] for r in classes.collect()} == {"sci.space": 2, "rec.autos": 1}
    assert files.where(F.col("path").endswith("/1")).first().text == "first\nfile"


def test_inline_and_range(spark):
    left = readers.inline_rows(spark, [("bob", "2015-01-13", 4), ("alice", "2015-04-23", 10)], ["name", "date", "duration"])
    right = readers.inline_rows(spark, [("alice", 100), ("bob", 23)], ["name", "upload"])
    assert left.join(right, ["name"]).columns == ["name", "date", "duration", "upload"]
    r = readers.integer_range(spark, 5, "myCol")
    assert r.union(readers.inline_rows(spark, [(9,)], ["other"])).columns == ["myCol"]
