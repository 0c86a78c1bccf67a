"""Text analysis over a folder of documents whose parent folder is the class (the source's
text-processing script): class sizes, token counts, stop words, term frequencies, the rarest
terms, stem conflation and word vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.strings import parent_folder
from tessera.operators import text
from tessera.sources.readers import whole_files


def read_documents(spark: SparkSession, path_glob: str) -> DataFrame:
    """``(path, text, doc_class)``, one row per file."""
    return whole_files(spark, path_glob).withColumn("doc_class", parent_folder("path"))


def class_sizes(docs: DataFrame) -> DataFrame:
    """Documents per class, ascending by count."""
    return docs.groupBy("doc_class").agg(F.count(F.lit(1)).alias("n")).orderBy("n", "doc_class")


def token_table(docs: DataFrame, key: str = "path") -> DataFrame:
    """Tokens and kept tokens per document, with their counts."""
    words = text.remove_stop_words(text.tokenize(docs, "text", "words"), "words", "filtered")
    return words.select(key, "words", "filtered", F.size("words").alias("tokens"), F.size("filtered").alias("filteredtokens"))


def corpus_summary(docs: DataFrame, rare: int = 20) -> dict[str, DataFrame]:
    """Kept-token total, distinct terms, the ``rare`` least frequent terms, and the
    vocabulary size before and after Porter stemming."""
    terms = text.corpus_terms(docs, "text")
    tf = text.term_frequency(terms)
    stems = text.stem_vocabulary(terms)
    totals = tf.agg(F.sum("n").alias("kept_tokens"), F.count(F.lit(1)).alias("distinct_terms"))
    return {
        "term_frequency": tf,
        "totals": totals,
        "rarest": text.rarest_terms(tf, rare),
        "stems": stems,
        "stem_sizes": stems.agg(F.count(F.lit(1)).alias("n_terms"), F.countDistinct("stem").alias("n_stems")),
    }


def without_rare_terms(docs: DataFrame, rare: int = 20, key: str = "path") -> DataFrame:
    """Kept tokens per document once the ``rare`` least frequent terms are removed."""
    table = token_table(docs, key)
    out = text.drop_rarest(table, "filtered", text.term_frequency(text.corpus_terms(docs, "text")), rare)
    return out.withColumn("filteredtokens", F.size("filtered"))


def synonyms(docs: DataFrame, word: str, k: int = 10, vector_size: int = 10, min_count: int = 0, seed: int = 42, rare: int = 20) -> DataFrame:
    """Rare words out, the rest stemmed, Word2Vec over the stems; the ``k`` stems nearest
    to ``word``'s stem (none for an unknown word)."""
    stems = text.stem_tokens(without_rare_terms(docs, rare), "filtered")
    model = text.word2vec(stems, "stemmed", vector_size=vector_size, min_count=min_count, seed=seed)
    asked = docs.sparkSession.createDataFrame([(word,)], "term string")
    return text.nearest_words(text.word_vectors(model), text.stem_vocabulary(asked).agg(F.first("stem")).scalar(), k)
