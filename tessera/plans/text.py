"""Text queries over ``documents`` and ``pages``."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tessera.functions.porter import stem_sql
from tessera.functions.stopwords import sql_list
from tessera.functions.strings import WORD_PATTERN, parent_folder
from tessera.operators import neighbours, text
from tessera.plans.registry import register
from tessera.session import ensure_checkpoint_dir, written
from tessera.sources.tables import load

_TOKENS = f"regexp_extract_all(lower(text), '{WORD_PATTERN}')"
_STOP = sql_list()
_KEPT_TOKENS_SQL = f"""
    toks AS (SELECT doc_id, unnest({_TOKENS}) AS term FROM documents),
    kept AS (SELECT doc_id, term FROM toks WHERE term NOT IN ({_STOP})),
    tf AS (SELECT term, count(*) AS n FROM kept GROUP BY term)"""


def _docs(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", "text")


def _filtered(spark, sf_dir):
    return text.remove_stop_words(text.tokenize(_docs(spark, sf_dir), "text", "words"), "words", "filtered")


def _terms(spark, sf_dir):
    return text.corpus_terms(_docs(spark, sf_dir), "text")


@register(
    "token_counts",
    sql=f"SELECT doc_id, CAST(len({_TOKENS}) AS INTEGER) AS n_tokens FROM documents",
)
def token_counts(spark, sf_dir):
    """Words per document."""
    docs = text.tokenize(_docs(spark, sf_dir), "text", "words")
    return docs.select("doc_id", F.size("words").cast("int").alias("n_tokens"))


@register(
    "stopword_filtered",
    sql=f"""
    SELECT doc_id, CAST(len({_TOKENS}) AS INTEGER) AS n_tokens,
           CAST(len(list_filter({_TOKENS}, lambda t: NOT list_contains([{_STOP}], t))) AS INTEGER) AS n_kept
    FROM documents""",
)
def stopword_filtered(spark, sf_dir):
    """Words per document before and after removing English stop words."""
    f = _filtered(spark, sf_dir)
    return f.select("doc_id", F.size("words").cast("int").alias("n_tokens"), F.size("filtered").cast("int").alias("n_kept"))


@register("term_frequency", sql=f"WITH {_KEPT_TOKENS_SQL} SELECT term, n FROM tf")
def term_frequency(spark, sf_dir):
    """Occurrences of every kept term over the corpus."""
    return text.term_frequency(_terms(spark, sf_dir))


@register("rarest_terms", sql=f"WITH {_KEPT_TOKENS_SQL} SELECT term, n FROM tf ORDER BY n, term LIMIT 20")
def rarest_terms(spark, sf_dir):
    """The 20 least frequent kept terms."""
    return text.rarest_terms(text.term_frequency(_terms(spark, sf_dir)), 20)


@register(
    "rare_word_filter",
    sql=f"""
    WITH {_KEPT_TOKENS_SQL},
    rare AS (SELECT term FROM tf ORDER BY n, term LIMIT 20)
    SELECT d.doc_id,
           CAST(count(k.term) FILTER (WHERE k.term NOT IN (SELECT term FROM rare)) AS INTEGER) AS n_kept
    FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
    GROUP BY d.doc_id""",
)
def rare_word_filter(spark, sf_dir):
    """Kept words per document once the 20 rarest terms are dropped too."""
    f = _filtered(spark, sf_dir)
    out = text.drop_rarest(f, "filtered", text.term_frequency(_terms(spark, sf_dir)), 20, out="kept")
    return out.select("doc_id", F.size("kept").cast("int").alias("n_kept"))


@register(
    "rare_list_filter",
    sql=f"""
    WITH {_KEPT_TOKENS_SQL},
    rare AS (SELECT term FROM tf WHERE n <= 2)
    SELECT d.doc_id,
           CAST(count(k.term) FILTER (WHERE k.term NOT IN (SELECT term FROM rare)) AS INTEGER) AS n_kept
    FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
    GROUP BY d.doc_id""",
)
def rare_list_filter(spark, sf_dir):
    """Kept words per document once all terms that occur at most twice are dropped, a list that grows
    with the corpus: an anti-join."""
    rare = text.term_frequency(_terms(spark, sf_dir)).where("n <= 2")
    out = text.drop_terms(_filtered(spark, sf_dir).select("doc_id", "filtered"), "doc_id", "filtered", rare, out="kept")
    return out.select("doc_id", F.size("kept").cast("int").alias("n_kept"))


@register(
    "doc_class_sizes",
    sql="""
    SELECT 'documents' AS kind, source AS doc_class, count(*) AS n FROM documents GROUP BY source
    UNION ALL
    SELECT 'pages', string_split(url, '/')[-2], count(*) FROM pages GROUP BY string_split(url, '/')[-2]""",
)
def doc_class_sizes(spark, sf_dir):
    """Documents per class (the source; for pages the URL's parent folder)."""
    docs = load(spark, sf_dir, "documents").groupBy(F.col("source").alias("doc_class")).agg(F.count(F.lit(1)).alias("n"))
    pages = (
        load(spark, sf_dir, "pages")
        .groupBy(parent_folder("url").alias("doc_class"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return docs.select(F.lit("documents").alias("kind"), "doc_class", "n").unionByName(
        pages.select(F.lit("pages").alias("kind"), "doc_class", "n")
    ).orderBy("n", "kind", "doc_class")


_STEMS_SQL = f"""
    WITH {_KEPT_TOKENS_SQL},
    v AS (SELECT DISTINCT term FROM kept),
    s AS ({stem_sql('v', 'term', 'regexp_matches')})"""


@register("stem_conflation", sql=f"{_STEMS_SQL} SELECT term, stem FROM s")
def stem_conflation(spark, sf_dir):
    """Each distinct kept term and its Porter stem (the vocabulary shrinks to the
    distinct stems)."""
    return text.stem_vocabulary(_terms(spark, sf_dir))


@register(
    "stem_vocab_sizes",
    sql=f"{_STEMS_SQL} SELECT count(*) AS n_terms, count(DISTINCT stem) AS n_stems FROM s",
)
def stem_vocab_sizes(spark, sf_dir):
    """Distinct kept terms before and after stemming (the conflation the source reports)."""
    stems = text.stem_vocabulary(_terms(spark, sf_dir))
    return stems.agg(F.count(F.lit(1)).alias("n_terms"), F.countDistinct("stem").alias("n_stems"))


def _stemmed(spark, sf_dir):
    """The source's chain: stop words out, the 20 rarest terms out, the rest stemmed, in order."""
    f = _filtered(spark, sf_dir)
    kept = text.drop_rarest(f, "filtered", text.term_frequency(_terms(spark, sf_dir)), 20, out="kept")
    return text.stem_tokens(kept.select("doc_id", "kept"), "kept")


_CHAIN_SQL = f"""
    WITH toks AS (SELECT doc_id, unnest({_TOKENS}) AS term, generate_subscripts({_TOKENS}, 1) AS pos FROM documents),
    kept AS (SELECT doc_id, term, pos FROM toks WHERE term NOT IN ({_STOP})),
    rare AS (SELECT term FROM kept GROUP BY term ORDER BY count(*), term LIMIT 20),
    left_over AS (SELECT * FROM kept WHERE term NOT IN (SELECT term FROM rare)),
    v AS (SELECT DISTINCT term FROM left_over),
    s AS ({stem_sql('v', 'term', 'regexp_matches')})"""


@register(
    "stem_tokens",
    sql=f"""{_CHAIN_SQL}
    SELECT d.doc_id, coalesce(string_agg(s.stem, ' ' ORDER BY k.pos), '') AS stems
    FROM documents d LEFT JOIN left_over k ON k.doc_id = d.doc_id LEFT JOIN s ON s.term = k.term
    GROUP BY d.doc_id""",
)
def stem_tokens(spark, sf_dir):
    """Every document's words after stop words and rare words have gone, stemmed, in order."""
    return _stemmed(spark, sf_dir).select("doc_id", F.array_join("stemmed", " ").alias("stems"))


def _stemmed_once(spark, sf_dir):
    """The chain's result, written once for all that read it."""
    return written(_stemmed(spark, sf_dir).select("doc_id", "stemmed"), "stems")


@register(
    "context_counts",
    sql=f"""{_CHAIN_SQL},
    seq AS (SELECT k.doc_id, s.stem, row_number() OVER (PARTITION BY k.doc_id ORDER BY k.pos) AS i
            FROM left_over k JOIN s ON s.term = k.term)
    SELECT x.stem AS a, y.stem AS b, count(*) AS n
    FROM seq x JOIN seq y ON x.doc_id = y.doc_id AND x.i <> y.i AND abs(x.i - y.i) <= 2
    GROUP BY x.stem, y.stem""",
)
def context_counts(spark, sf_dir):
    """How often two stems stand within two words of each other, over all documents."""
    ensure_checkpoint_dir(spark)
    counts = text.context_counts(_stemmed_once(spark, sf_dir), "stemmed", 2)
    return counts.select("a", "b", F.col("n").cast("long").alias("n"))


def _w2v(stems):
    return text.vectors_of_words(stems, "stemmed", vector_size=10, min_count=1, seed=42)


@register(
    "word_vector_words",
    sql=f"{_CHAIN_SQL} SELECT DISTINCT stem AS word, CAST(10 AS INTEGER) AS dims FROM s",
)
def word_vector_words(spark, sf_dir):
    """Every stem, and no other word, gets a vector of ten dimensions."""
    ensure_checkpoint_dir(spark)
    v = _w2v(_stemmed_once(spark, sf_dir))
    return v.select("word", F.size(vector_to_array("vector")).alias("dims"))


@register("word_vectors")
def word_vectors(spark, sf_dir):
    """Word vectors (10 dimensions, skip-gram) over the stems; ``(word, vector as text)``."""
    ensure_checkpoint_dir(spark)
    v = _w2v(_stemmed_once(spark, sf_dir))
    return v.select("word", F.array_join(F.transform(vector_to_array("vector"), lambda x: F.format_number(x, 6)), ",").alias("vector"))


@register("synonyms")
def synonyms(spark, sf_dir):
    """The ten stems nearest (cosine) to the most frequent one."""
    ensure_checkpoint_dir(spark)
    stemmed = _stemmed_once(spark, sf_dir)
    stems = stemmed.select(F.explode("stemmed").alias("term"))
    top_word = text.term_frequency(stems).orderBy(F.desc("n"), "term").limit(1).agg(F.first("term")).scalar()
    return text.nearest_words(_w2v(stemmed).checkpoint(), top_word, 10).select("word", "similarity")


@register("context_neighbours")
def context_neighbours(spark, sf_dir):
    """M15-M17 for vocabularies beyond the driver: factors of the co-occurrence table for every stem, and
    every stem's five nearest by the index."""
    ensure_checkpoint_dir(spark)
    factors = text.context_factors(_stemmed_once(spark, sf_dir), "stemmed", window=2).checkpoint()
    near = neighbours.nearest_by_index(factors, "id", "features", 5, tables=8, bucket=512)
    names = lambda c, out: factors.select(F.col("id").alias(c), F.col("word").alias(out))
    named = near.join(names("id", "word"), "id").join(names("neighbour", "near"), "neighbour")
    return named.select("word", "rank", "near", F.round("similarity", 5).alias("similarity"))


_DOTS = "list_dot_product(CAST({0} AS DOUBLE[]), CAST({1} AS DOUBLE[]))"


@register(
    "nearest_vectors",
    sql=f"""
    WITH p AS (
      SELECT q.vec_id, e.vec_id AS neighbour,
             {_DOTS.format("q.embedding", "e.embedding")}
             / (sqrt({_DOTS.format("q.embedding", "q.embedding")}) * sqrt({_DOTS.format("e.embedding", "e.embedding")})) AS cos
      FROM embeddings q, embeddings e WHERE q.vec_id % 100 = 0 AND q.vec_id <> e.vec_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY cos DESC, neighbour) AS rnk FROM p)
    SELECT vec_id, CAST(rnk AS INTEGER) AS rank, neighbour, round(cos, 6) AS similarity FROM r WHERE rnk <= 10""",
)
def nearest_vectors(spark, sf_dir):
    """The ten rows nearest by cosine, among all, to every row whose id is divisible by 100."""
    ensure_checkpoint_dir(spark)
    e = load(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    out = neighbours.nearest_exact(e, e.where("vec_id % 100 = 0"), "vec_id", "embedding", 10)
    return out.select("vec_id", "rank", "neighbour", F.round("similarity", 6).alias("similarity"))


@register("nearest_vectors_index")
def nearest_vectors_index(spark, sf_dir):
    """For every row the ten nearest by cosine that the hyperplane index finds."""
    ensure_checkpoint_dir(spark)
    e = load(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    out = neighbours.nearest_by_index(e, "vec_id", "embedding", 10)
    return out.select("vec_id", "rank", "neighbour", F.round("similarity", 6).alias("similarity"))
