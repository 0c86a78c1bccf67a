"""End-to-end analyses on small invented inputs written by the test (no source data)."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from tessera.analyses import bike_hours, evergreen, movielens, newsgroups
from tessera.sources.readers import csv_with_header, quoted_tsv
from tessera.streaming import jobs, streams


def _write(path, lines, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding) as fh:
        fh.write("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def movie_files():
    d = tempfile.mkdtemp(prefix="tessera-ml-")
    _write(f"{d}/users.psv", ["1|24|M|technician|85711", "2|53|F|other|94043", "3|23|M|writer|32067",
                            "4|24|M|technician|43537", "5|33|F|other|15213", "6|42|M|executive|T8H1N"])
    rows = []
    for i, (title, date) in enumerate([("Seven (Se7en) (1995)", "01-Jan-1995"), ("Toy Story (1995)", "01-Jan-1995"),
                                       ("A (b c) (1999)", "01-Jan-1999"), ("No Date", ""), ("Heat (1995)", "15-Dec-1995")], start=1):
        flags = ["1" if (g % 5) == (i % 5) or g == i else "0" for g in range(19)]
        rows.append("|".join([str(i), title, date, "", "http://x"] + flags))
    _write(f"{d}/items.psv", rows, encoding="latin-1")
    _write(f"{d}/genres.psv", [f"kind{g}|{g}" for g in range(19)] + [""])
    rnd = random.Random(7)
    ratings = [f"{u}\t{i}\t{rnd.randint(1, 5)}\t{880000000 + 3600 * rnd.randint(0, 48)}" for u in range(1, 7) for i in range(1, 6) if (u + i) % 4]
    _write(f"{d}/ratings.tsv", ratings)
    return d


def test_movielens_exploration(spark, movie_files):
    users = movielens.read_users(spark, f"{movie_files}/users.psv")
    o = movielens.user_overview(users).first()
    assert (o.n_users, o.n_genders, o.n_occupations, o.min_age, o.max_age) == (6, 2, 4, 23, 53)
    occ = movielens.occupation_counts(users).collect()
    assert [(r.occupation, r.n) for r in occ][-2:] == [("other", 2), ("technician", 2)]
    assert sum(r.n for r in movielens.age_histogram(users, 4).collect()) == 6
    halves = {r.id: r.half for r in movielens.postcode_halves(users).collect()}
    assert halves[1] == 42855.5 and halves[6] is None
    vec = movielens.occupation_one_hot(users).select("occ_idx_vec").first()[0]
    assert vec.size == 3
    items = movielens.read_items(spark, f"{movie_files}/items.psv")
    years = {r.itemid: (r.year, r.year_filled) for r in movielens.release_years(items).collect()}
    assert years[4][0] == 1900 and years[4][1] == pytest.approx((1995 * 3 + 1999) / 4)
    vocab, bag = movielens.title_terms(items)
    assert "Seven" in {r.term for r in vocab.collect()} and "Se7en" not in {r.term for r in vocab.collect()}
    assert bag.count() > 0


def test_movielens_ratings_and_genres(spark, movie_files):
    ratings = movielens.read_ratings(spark, f"{movie_files}/ratings.tsv")
    items = movielens.read_items(spark, f"{movie_files}/items.psv")
    genres = movielens.read_genres(spark, f"{movie_files}/genres.psv")
    assert genres.count() == 19
    ov = movielens.rating_overview(ratings).first()
    vals = [r.rating for r in ratings.collect()]
    assert ov.n_ratings == len(vals) and ov.max == max(vals) and ov.median == pytest.approx(sorted(vals)[len(vals) // 2] if len(vals) % 2 else (sorted(vals)[len(vals) // 2 - 1] + sorted(vals)[len(vals) // 2]) / 2)
    top = movielens.top_rated_for_user(ratings, items, 1, 3).collect()
    assert [r.rating for r in top] == sorted([r.rating for r in top], reverse=True)
    periods = {r.period for r in movielens.rating_hours(ratings).collect()}
    assert periods <= {"morning", "lunch", "afternoon", "evening", "night"}
    names = {r.itemid: r.genres for r in movielens.genre_names(items, genres).collect()}
    assert names[1] == "kind1, kind6, kind11, kind16"


def test_movie_clusters(spark, movie_files):
    ratings = movielens.read_ratings(spark, f"{movie_files}/ratings.tsv")
    items = movielens.read_items(spark, f"{movie_files}/items.psv")
    genres = movielens.read_genres(spark, f"{movie_files}/genres.psv")
    out = movielens.movie_clusters(ratings, items, genres, k=2, seed=1, top=2)
    assert sum(r["size"] for r in out["sizes"].collect()) == items.join(ratings, "itemid", "left_semi").count()
    assert {r.model for r in out["costs"].collect()} == {"kmeans", "bisecting_kmeans"}
    nearest = out["nearest"].collect()
    assert all(r.rnk <= 2 for r in nearest) and all(r.title for r in nearest)


def test_evergreen_compare(spark):
    rnd = random.Random(3)
    d = tempfile.mkdtemp(prefix="tessera-eg-")
    header = ["url", "urlid", "boilerplate", "alchemy_category"] + [f"x{i}" for i in range(9)] + ["label"]
    lines = ["\t".join(f'"{h}"' for h in header)]
    for i in range(120):
        label = i % 2
        xs = [("?" if rnd.random() < 0.1 else f"{rnd.gauss(label, 1):.3f}") for _ in range(9)]
        cat = rnd.choice(["business", "sports", "?"])
        lines.append("\t".join(f'"{v}"' for v in [f"http://p{i}", str(i), "{}", cat] + xs + [str(label)]))
    _write(f"{d}/pages.tsv", lines)
    raw = quoted_tsv(spark, f"{d}/pages.tsv")
    clean = evergreen.clean_table(raw)
    assert dict(clean.dtypes)["x0"] == "double" and clean.where(F.col("x0") < 0).count() == 0
    out = evergreen.compare_classifiers(raw).collect()
    combos = {(r.model, r.features) for r in out}
    assert ("naive_bayes", "f_raw") in combos and ("naive_bayes", "f_scaled") not in combos
    assert len(out) == 2 * (4 + 4 + 2 + 4) and all(0 <= r.value <= 1 for r in out)


def test_bike_hours_compare(spark):
    rnd = random.Random(5)
    d = tempfile.mkdtemp(prefix="tessera-bike-")
    lines = ["instant,dteday,season,yr,mnth,hr,holiday,weekday,workingday,weathersit,temp,atemp,hum,windspeed,casual,registered,cnt"]
    for i in range(240):
        hr = i % 24
        cnt = 20 + 10 * (hr in (8, 17, 18)) * 10 + rnd.randint(0, 5)
        casual = cnt // 3
        lines.append(f"{i + 1},2011-01-{1 + i // 24:02d},1,0,1,{hr},0,{(i // 24) % 7},1,{1 + hr % 3},{rnd.random():.2f},{rnd.random():.2f},{rnd.random():.2f},{rnd.random():.2f},{casual},{cnt - casual},{cnt}")
    _write(f"{d}/hours.csv", lines)
    hours = csv_with_header(spark, f"{d}/hours.csv", bike_hours.SCHEMA)
    prep = bike_hours.prepare(hours)
    assert "casual" not in prep.columns and prep.where(F.col("isWeekend") == 1.0).count() > 0
    out = bike_hours.compare_regressors(hours).collect()
    assert {r.model for r in out} >= {"linear_regression", "decision_tree", "random_forest", "gbt", "linear_regression_log_target"}
    assert all(r.value >= 0 for r in out)


def test_newsgroups(spark):
    d = tempfile.mkdtemp(prefix="tessera-news-")
    _write(f"{d}/sci.space/1", ["Subject: robots in orbit", "The robots were running experiments."])
    _write(f"{d}/sci.space/2", ["A robot ran; zyzzyva appears once."])
    _write(f"{d}/rec.autos/3", ["Cars and engines, engines running."])
    docs = newsgroups.read_documents(spark, f"{d}/*/*")
    assert [(r.doc_class, r.n) for r in newsgroups.class_sizes(docs).collect()] == [("rec.autos", 1), ("sci.space", 2)]
    summary = newsgroups.corpus_summary(docs, rare=3)
    tot = summary["totals"].first()
    table = newsgroups.token_table(docs)
    assert tot.kept_tokens == table.agg(F.sum("filteredtokens")).first()[0]
    sizes = summary["stem_sizes"].first()
    assert sizes.n_stems < sizes.n_terms
    cut = newsgroups.without_rare_terms(docs, rare=3)
    assert cut.agg(F.sum("filteredtokens")).first()[0] == tot.kept_tokens - sum(r.n for r in summary["rarest"].collect())
    assert newsgroups.synonyms(docs, "robots", k=3, vector_size=4, rare=3).count() == 3


def test_stream_jobs(spark):
    base = tempfile.mkdtemp(prefix="tessera-jobs-")
    src = f"{base}/purchases"
    _write(f"{src}/b1.txt", ["u,p,5.5", "v,p,1", "u,q,2.25"])
    m = jobs.purchase_monitor(streams.line_stream(spark, src), f"{base}/out", f"{base}/ck", trigger={"availableNow": True})
    m.awaitTermination()
    metrics = spark.read.parquet(f"{base}/out/metrics").first()
    assert (metrics.n_purchases, metrics.unique_users, metrics.revenue) == (3, 2, 8.75)
    state = {r.user: (r.n_purchases, r.revenue) for r in streams.merged_counts(spark, f"{base}/out/totals", "user", ["n_purchases", "revenue"]).collect()}
    assert state == {"u": (2, 7.75), "v": (1, 1.0)}
    lab = f"{base}/labelled"
    _write(f"{lab}/b1.txt", [f"{2 * i + 1}.0\t{i},{i % 3}" for i in range(12)] + ["bad\t1,2"])
    q = jobs.regression_monitor(streams.line_stream(spark, lab), f"{base}/reg", f"{base}/reg_ck", save_after=10, trigger={"availableNow": True})
    q.awaitTermination()
    row = spark.read.parquet(f"{base}/reg/metrics").first()
    assert (row.samples, row.rejected, row.total_samples, row.saved) == (12, 1, 12, True)
    assert os.path.isdir(f"{base}/reg/model")
