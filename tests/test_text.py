"""Text operators on small inline corpora."""

from pyspark.sql import functions as F

from tessera.operators import skipgram, text


def _docs(spark):
    rows = [(1, "The robot and the robots were running. Robots run!"), (2, "A rare word: zyzzyva; the end"), (3, "")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_tokenize_and_stop_words(spark):
    f = text.remove_stop_words(text.tokenize(_docs(spark), "text"), "words")
    got = {r.doc_id: r.filtered for r in f.collect()}
    assert got[1] == ["robot", "robots", "running", "robots", "run"]
    assert got[2] == ["rare", "word", "zyzzyva", "end"]
    assert got[3] == []


def test_corpus_terms_equal_filtered_arrays(spark):
    f = text.remove_stop_words(text.tokenize(_docs(spark), "text"), "words")
    from_arrays = sorted(r[0] for r in f.select(F.explode("filtered")).collect())
    direct = sorted(r.term for r in text.corpus_terms(_docs(spark), "text").collect())
    assert from_arrays == direct


def test_tokenizer_stage_matches_function(spark):
    docs = _docs(spark)
    a = {r.doc_id: r.words for r in text.tokenize(docs, "text").collect()}
    b = {r.doc_id: r.words for r in text.tokenizer_stage("text").transform(docs).collect()}
    assert a == b


def test_rare_terms_and_drop(spark):
    f = text.remove_stop_words(text.tokenize(_docs(spark), "text"), "words")
    tf = text.term_frequency(text.corpus_terms(_docs(spark), "text"))
    assert dict(tf.collect())["robots"] == 2
    rare = text.rarest_terms(tf, 2)
    assert [r.term for r in rare.collect()] == ["end", "rare"]
    kept = text.drop_rarest(f, "filtered", tf, 2, out="kept")
    assert {r.doc_id: r.kept for r in kept.collect()}[2] == ["word", "zyzzyva"]


def test_stems_conflate_vocabulary(spark):
    f = text.remove_stop_words(text.tokenize(_docs(spark), "text"), "words")
    stems = {r.term: r.stem for r in text.stem_vocabulary(text.corpus_terms(_docs(spark), "text")).collect()}
    assert stems["robots"] == "robot" and stems["running"] == "run"
    assert len(set(stems.values())) < len(stems)
    out = text.stem_tokens(f, "filtered")
    assert {r.doc_id: r.stemmed for r in out.collect()}[1] == ["robot", "robot", "run", "robot", "run"]


def test_nearest_words_cosine(spark):
    from pyspark.ml.linalg import Vectors

    vecs = spark.createDataFrame(
        [("a", Vectors.dense([1.0, 0.0])), ("b", Vectors.dense([1.0, 0.1])), ("c", Vectors.dense([0.0, 1.0]))],
        ["word", "vector"],
    )
    out = text.nearest_words(vecs, "a", 2).collect()
    assert [r.word for r in out] == ["b", "c"]
    assert out[0].similarity == "0.99504" and out[1].similarity == "0.00000"


def test_word2vec_vectors(spark):
    f = text.remove_stop_words(text.tokenize(_docs(spark), "text"), "words")
    model = text.word2vec(f, "filtered", vector_size=4, seed=1)
    v = text.word_vectors(model)
    assert v.count() == f.select(F.explode("filtered")).distinct().count()


def test_drop_terms_and_drop_rarest_agree(spark):
    f = text.remove_stop_words(text.tokenize(_docs(spark), "text"), "words")
    f = f.unionByName(spark.createDataFrame([(4, None, None, None)], f.schema))
    tf = text.term_frequency(text.corpus_terms(_docs(spark), "text"))
    by_k = {r.doc_id: r.kept for r in text.drop_rarest(f, "filtered", tf, 2, out="kept").collect()}
    by_list = {r.doc_id: r.kept for r in text.drop_terms(f, "doc_id", "filtered", text.rarest_terms(tf, 2), out="kept").collect()}
    assert by_k == by_list and by_k[3] == [] and by_k[4] is None
    assert by_k[1] == ["robot", "robots", "running", "robots", "run"]


def test_unknown_word_has_no_neighbours(spark):
    from pyspark.ml.linalg import Vectors

    vecs = spark.createDataFrame([("a", Vectors.dense([1.0, 0.0])), ("b", Vectors.dense([1.0, 0.1]))], ["word", "vector"])
    assert text.nearest_words(vecs, "zzz", 5).count() == 0


def test_context_factors_cover_the_words(spark):
    docs = text.remove_stop_words(text.tokenize(_docs(spark), "text"), "words")
    found = text.context_factors(docs, "filtered", rank=3, window=2, blocks=2)
    words = {w for r in docs.collect() for w in r.filtered if len(r.filtered) > 1}
    assert {r.word for r in found.collect()} == words and all(len(r.features) == 3 for r in found.collect())


def test_blocks_of_the_factorisation_grow_with_the_pairs(spark, monkeypatch):
    from tessera.operators import models

    seen = []
    real = text.ALS
    monkeypatch.setattr(text, "ALS", lambda **kw: seen.append((kw["numUserBlocks"], kw["numItemBlocks"])) or real(**kw))
    docs = spark.createDataFrame([(1, [f"w{i}" for i in range(30)])], "doc_id long, words array<string>")
    text.context_factors(docs, "words", rank=2, window=1, max_iter=1, blocks=2)
    monkeypatch.setattr(models, "BLOCK_ROWS", 10)  # 29 pairs, 58 with both directions
    found = text.context_factors(docs, "words", rank=2, window=1, max_iter=1, blocks=2)
    assert seen == [(2, 2), (6, 6)]
    assert {r.word for r in found.collect()} == {f"w{i}" for i in range(30)}


def test_stop_word_filter_equals_ml_stage(spark):
    docs = spark.createDataFrame([(1, ["The", "robot", "and", "THE", "robots", "it's"])], "doc_id long, words array<string>")
    ours = text.remove_stop_words(docs, "words").first().filtered
    ml = text.stop_words_stage("words").transform(docs).first().filtered
    assert ours == ml == ["robot", "robots"]


def test_stems_in_place_equal_the_vocabulary_s(spark):
    words = ["robots", "running", "yearly", "syzygy", "été", "x1s", "abc#", "at", "hopping", "sky", "relational", "feed", "caresses", ""]
    df = spark.createDataFrame([(1, words), (2, None), (3, []), (4, [None, "cats"])], "doc_id long, words array<string>")
    got = {r.doc_id: r.stemmed for r in text.stem_tokens(df, "words").collect()}
    stems = {r.term: r.stem for r in text.stem_vocabulary(df.select(F.explode("words").alias("term"))).collect()}
    assert got[1] == [stems[w] for w in words] and got[2] is None and got[3] == [] and got[4] == [None, "cat"]
    assert "Exchange" not in text.stem_tokens(df, "words")._jdf.queryExecution().toString()


def test_context_counts_by_force(spark):
    rows = [(1, "a b a c b".split()), (2, ["a"]), (3, []), (4, None), (5, ["b", "b", "b"])]
    want = {}
    for _, words in rows:
        for i, a in enumerate(words or []):
            for j, b in enumerate(words):
                if i != j and abs(i - j) <= 2:
                    want[a, b] = want.get((a, b), 0) + 1
    got = text.context_counts(spark.createDataFrame(rows, "doc_id long, words array<string>"), "words", 2)
    assert {(r.a, r.b): r.n for r in got.collect()} == want


def test_stems_in_tasks_equal_the_columns_s(spark):
    from tessera.functions.porter import STEP2_RULES, STEP3_RULES, STEP4_SUFFIXES, stem_of, with_stem

    bases = ["", "t", "fe", "hop", "fall", "sky", "yell", "rel", "conflat", "siz", "tann", "controll", "trou", "y", "oat", "ss", "adopt", "cr", "été", "a1"]
    ends = [s for s, _ in (*STEP2_RULES, *STEP3_RULES)] + [*STEP4_SUFFIXES, "s", "sses", "ies", "eed", "ed", "ing", "y", "e", "ll", "ings", "edly", "", "#", "A"]
    words = sorted({a + b + e for a in bases for b in ends for e in ("", "s", "ed", "ing", "ly")})
    df = spark.createDataFrame([(w,) for w in words], "w0 string")
    want = {r.w0: r.stem for r in with_stem(df, "w0").collect()}
    assert {w: stem_of(w) for w in words} == want


def test_a_pair_is_shuffled_once(spark):
    rows = [(1, ["b", "a", None, "b", "b"])]
    df = spark.createDataFrame(rows, "doc_id long, words array<string>")
    got = {(r.a, r.b): r.n for r in text.context_counts(df, "words", 1).collect()}
    assert got == {("a", "b"): 1, ("b", "a"): 1, ("a", None): 1, (None, "a"): 1, (None, "b"): 1, ("b", None): 1, ("b", "b"): 2}
    assert text.context_counts(df, "words", 1)._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def _topics(spark, rows=400):
    import random

    pick = random.Random(3)
    docs = [(d, [f"t{d % 2}n{pick.randrange(20)}" for _ in range(60)]) for d in range(rows)]
    return spark.createDataFrame([*docs, (rows, None), (rows + 1, []), (rows + 2, ["alone"]), (rows + 3, [None, "t0n0"])], "d long, words array<string>")


def test_skip_gram_beyond_the_driver(spark, monkeypatch):
    import numpy as np

    def never(*args, **kwargs):
        raise AssertionError("the vocabulary is held by the driver")

    docs = _topics(spark)
    small = text.vectors_of_words(docs.where("d < 400"), "words", driver_words=1000)
    assert small.count() == 40  # by Spark's estimator
    monkeypatch.setattr(text, "word2vec", never)
    got = {r.word: r.vector.toArray() for r in text.vectors_of_words(docs, "words", driver_words=10).collect()}
    assert set(got) == {f"t{t}n{n}" for t in (0, 1) for n in range(20)} | {"alone"}
    assert all(len(v) == 10 and np.isfinite(v).all() for v in got.values())
    unit = {w: v / np.linalg.norm(v) for w, v in got.items()}
    near = lambda a, b: np.mean([unit[f"t{a}n{i}"] @ unit[f"t{b}n{j}"] for i in range(20) for j in range(20) if (a, i) != (b, j)])
    assert min(near(0, 0), near(1, 1)) > near(0, 1) + 0.3
    many = _topics(spark, 2000)  # three shards
    shards = {r.word: r.vector.toArray() for r in skipgram.skip_gram_vectors(many, "words", shard_words=40_000).collect()}
    assert set(shards) == set(got)
    unit = {w: v / np.linalg.norm(v) for w, v in shards.items()}
    assert min(near(0, 0), near(1, 1)) > near(0, 1) + 0.3
    often = text.vectors_of_words(docs, "words", min_count=2, driver_words=10)
    assert {r.word for r in often.collect()} == set(got) - {"alone"}
