"""Text operators (M09-M18): tokens, stop words, term frequency, rare words, stems,
word vectors and nearest words.

Tokens are built with JVM regex functions; corpus statistics are exploded-token aggregates
with map-side combining (a hot term costs one row per task, not one per occurrence). Stems
are column expressions over the *distinct* vocabulary, joined back.
"""

from __future__ import annotations

from pyspark.ml.feature import RegexTokenizer, StopWordsRemover, Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.porter import stems_of, with_stem
from tessera.functions.stopwords import ENGLISH_STOP_WORDS
from tessera.functions.strings import WORD_PATTERN, tokens
from tessera.operators.models import als_blocks
from tessera.operators.positions import global_index
from tessera.operators.skipgram import skip_gram_vectors
from tessera.session import written


def tokenize(df: DataFrame, text_col: str, out: str = "words") -> DataFrame:
    """Lower-cased word tokens (2+ letters/digits/underscores, any script)."""
    return df.withColumn(out, tokens(text_col))


def tokenizer_stage(text_col: str, out: str = "words") -> RegexTokenizer:
    """M09 as an ML stage (same pattern) for pipelines."""
    return RegexTokenizer(inputCol=text_col, outputCol=out, pattern=WORD_PATTERN, gaps=False, toLowercase=True)


def remove_stop_words(df: DataFrame, words_col: str, out: str = "filtered", stop_words=ENGLISH_STOP_WORDS) -> DataFrame:
    """Drop stop words (case-insensitive), keeping order and repeats.

    A built-in ``filter`` with a hash-set ``isin``: same result as ``StopWordsRemover`` with
    ``caseSensitive=False``, without converting each array to and from JVM objects.
    """
    listed = [w.lower() for w in stop_words]
    return df.withColumn(out, F.filter(F.col(words_col), lambda w: ~F.lower(w).isin(listed)))


def stop_words_stage(words_col: str, out: str = "filtered", stop_words=ENGLISH_STOP_WORDS) -> StopWordsRemover:
    """M10 as an ML stage for pipelines."""
    return StopWordsRemover(inputCol=words_col, outputCol=out, stopWords=list(stop_words), caseSensitive=False)


def corpus_terms(df: DataFrame, text_col: str, keys=(), stop_words=ENGLISH_STOP_WORDS, term: str = "term") -> DataFrame:
    """One row per kept token occurrence: ``(*keys, term)``.

    The token expression is exploded directly and stop words are dropped afterwards by a
    hash-set ``isin``: exploding a materialised array column instead makes the generated
    code copy the whole array for every output row, quadratic in document length.
    """
    out = df.select(*keys, F.explode(tokens(text_col)).alias(term))
    if stop_words:
        out = out.where(~F.col(term).isin(list(stop_words)))
    return out


def term_frequency(terms: DataFrame, term: str = "term", name: str = "n") -> DataFrame:
    """Occurrences per term over the corpus (partial aggregation before the shuffle)."""
    return terms.groupBy(term).agg(F.count(F.lit(1)).alias(name))


def rarest_terms(freq: DataFrame, k: int = 20, term: str = "term", name: str = "n") -> DataFrame:
    """The k least frequent terms, ties by term."""
    return freq.orderBy(name, term).limit(k)


def drop_rarest(df: DataFrame, words_col: str, freq: DataFrame, k: int, out: str | None = None) -> DataFrame:
    """Remove the ``k`` rarest terms of ``freq`` from each token array, order and repeats kept.

    The list has ``k`` terms by construction: a scalar subquery folds it into one array, which is
    tested per token in the JVM. A null array stays null.
    """
    listed = rarest_terms(freq, k).agg(F.collect_list("term")).scalar()
    with_list = df.withColumn("_listed", listed)  # subqueries may not sit inside a lambda
    kept = F.filter(F.col(words_col), lambda w: ~F.array_contains(F.col("_listed"), w))
    return with_list.withColumn(out or words_col, kept).drop("_listed")


def drop_terms(df: DataFrame, key: str, words_col: str, terms: DataFrame, term: str = "term", out: str | None = None) -> DataFrame:
    """As :func:`drop_rarest` for a list of any length: an anti-join on the exploded
    tokens, regrouped per ``key`` (a row identifier) in their order. A null array stays null."""
    out = out or words_col
    exploded = df.select(key, F.posexplode(words_col).alias("_pos", "_term"))
    kept = exploded.join(terms.select(F.col(term).alias("_term")), "_term", "left_anti")
    regrouped = _in_order(kept, key, "_pos", "_term", "_kept")
    empty = F.when(F.col(words_col).isNotNull(), F.array().cast("array<string>"))
    return df.join(regrouped, key, "left").withColumn(out, F.coalesce("_kept", empty)).drop("_kept")


def _in_order(tokens_: DataFrame, key: str, pos: str, value: str, out: str) -> DataFrame:
    pairs = F.array_sort(F.collect_list(F.struct(pos, value)))
    return tokens_.groupBy(key).agg(F.transform(pairs, lambda s: s[value]).alias(out))


def stem_vocabulary(terms: DataFrame, term: str = "term") -> DataFrame:
    """``(term, stem)`` for each distinct term of :func:`corpus_terms`, by column expressions."""
    return with_stem(terms.select(term).distinct(), term)


def stem_tokens(df: DataFrame, words_col: str, out: str = "stemmed") -> DataFrame:
    """Replace each token by its stem, keeping token order. Every row's tokens stay where they are:
    nothing is shuffled. A null array stays null."""
    return df.withColumn(out, stems_of(f"`{words_col}`"))


def word2vec(df: DataFrame, words_col: str, vector_size: int = 10, min_count: int = 0, seed: int = 42, partitions: int = 8):
    """Fit ``Word2Vec``; training is split over ``partitions``, whatever the cluster's size, so
    the vectors do not change with it. The estimator holds the vocabulary of words seen
    ``min_count`` times in the driver; for a vocabulary beyond that use :func:`vectors_of_words`."""
    w2v = Word2Vec(
        vectorSize=vector_size, minCount=min_count, inputCol=words_col, outputCol="doc_vector", seed=seed, numPartitions=partitions
    )
    return w2v.fit(df)


def vectors_of_words(
    df: DataFrame, words_col: str, vector_size: int = 10, min_count: int = 1, seed: int = 42, driver_words: int = 100_000
) -> DataFrame:
    """``(word, vector)`` of every word that occurs ``min_count`` times, for a vocabulary of any size:
    up to ``driver_words`` different words by :func:`word2vec`, which holds them in the driver, beyond that by
    :func:`tessera.operators.skipgram.skip_gram_vectors`, which holds none there. The result is trained when it
    is read: write it before reading it twice. ``df`` is read several times."""
    some = df.select(F.explode(words_col).alias("word")).distinct().limit(driver_words + 1).count()
    if some <= driver_words:
        return word_vectors(word2vec(df, words_col, vector_size, min_count, seed))
    return skip_gram_vectors(df, words_col, vector_size, min_count, seed=seed)


def _pair_counts(df: DataFrame, words_col: str, window: int) -> DataFrame:
    """``(a, b, n)``: how often ``a`` and ``b`` stand within ``window`` words of each other, one row for each pair,
    the lesser word first (null before all). The partial aggregate adds up before the only shuffle."""
    ahead = F.explode(F.expr(f"transform({words_col}, (w, i) -> struct(w as a, slice({words_col}, i + 2, {int(window)}) as bs))"))
    near = df.select(ahead.alias("s")).select(F.col("s.a").alias("a"), F.explode("s.bs").alias("b"))
    a, b = F.col("a"), F.col("b")
    turned = F.coalesce(a > b, a.isNotNull())
    lesser, greater = F.when(turned, b).otherwise(a).alias("a"), F.when(turned, a).otherwise(b).alias("b")
    return near.select(lesser, greater).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


def _both_ways(pairs: DataFrame, a: str, b: str, n: str) -> DataFrame:
    """:func:`_pair_counts` with a row for each direction; a word beside itself counts from both."""
    row = lambda x, y, m: F.struct(F.col(x).alias(a), F.col(y).alias(b), m.alias(n))
    alone = F.col(a).eqNullSafe(F.col(b))
    return pairs.select(F.inline(
        F.when(alone, F.array(row(a, b, F.col(n) * 2))).otherwise(F.array(row(a, b, F.col(n)), row(b, a, F.col(n))))
    ))


def context_counts(df: DataFrame, words_col: str, window: int = 5) -> DataFrame:
    """``(a, b, n)``: how often ``b`` stands within ``window`` words before or after ``a``, over all rows.

    Each pair is counted and shuffled once, whichever word comes first; the other direction is the same
    count and made afterwards, in place.
    """
    return _both_ways(_pair_counts(df, words_col, window), "a", "b", "n")


def context_factors(df: DataFrame, words_col: str, rank: int = 10, window: int = 5, max_iter: int = 5, blocks: int = 10, seed: int = 42) -> DataFrame:
    """M15/M16 without a vocabulary in the driver: ``(id, word, features)``, factors of
    :func:`context_counts` (implicit-feedback ALS); ``id`` numbers the words in order. Each pair is written and
    joined once; its other direction is made at the fit. ``blocks``: at least; more pairs have more, so that a
    task of the fit holds a bounded number of them."""
    counts = written(_pair_counts(df, words_col, window), "pairs")  # read by the numbering and by the fit
    words = counts.select(F.explode(F.array("a", "b")).alias("word")).distinct()
    ids = global_index(words, ["word"], "id").withColumn("id", F.col("id").cast("int"))
    left, right = ids.toDF("a", "i"), ids.toDF("b", "j")
    numbered = counts.join(left, "a").join(right, "b").select("i", "j", "n")
    table = _both_ways(numbered, "i", "j", "n").withColumn("n", F.col("n").cast("float"))
    blocks = als_blocks(2 * counts.count(), blocks)
    model = ALS(rank=rank, maxIter=max_iter, implicitPrefs=True, userCol="i", itemCol="j", ratingCol="n", seed=seed,
                numUserBlocks=blocks, numItemBlocks=blocks, checkpointInterval=1).fit(table)
    return model.userFactors.join(ids, "id").select("id", "word", "features")


def word_vectors(model) -> DataFrame:
    """``(word, vector)``."""
    return model.getVectors()


def nearest_words(vectors: DataFrame, word: str | Column, k: int = 10) -> DataFrame:
    """M17 for one word (for all words: :mod:`tessera.operators.neighbours`): the k words most
    cosine-similar to ``word``, computed over the vector table in parallel (not in the driver): ``(word, similarity)``, ``similarity`` formatted to 5
    places as in the source. An unknown word gives no rows."""
    v = vectors.select("word", vector_to_array("vector").alias("v"))
    target = v.where(F.col("word") == word).agg(F.first("v")).scalar()
    # subqueries may not sit inside a lambda; an unknown word has no neighbours
    v = v.where(F.col("word") != word).withColumn("_t", target).where(F.col("_t").isNotNull())
    dot = F.aggregate(F.zip_with("v", "_t", lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
    norm = lambda a: F.sqrt(F.aggregate(F.transform(a, lambda x: x * x), F.lit(0.0), lambda acc, x: acc + x))
    sims = v.select("word", F.try_divide(dot, norm(F.col("v")) * norm(F.col("_t"))).alias("cos"))
    top = sims.orderBy(F.desc("cos"), "word").limit(k)
    return top.select("word", F.format_number("cos", 5).alias("similarity"), "cos")
