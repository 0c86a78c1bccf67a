"""Corpus pipeline: documents go through the stages in order; each stage's result is written as
Parquet and read again as the next one's input.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the
columns of ``docs``. Null and empty texts pass all stages, as does any further column; an empty
table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, line_dedup, ngram_join, packing, toxicity
from tessera.llm.stage import shared_folder, table

TOKENIZER = "byte_bpe_50k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go; the model learns from the labelled ones among them."""
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line repeats go; ``n_chars`` follows the text."""
    out = line_dedup.drop_repeated_lines(docs)
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(size))
    return out.select(*[f"`{c}`" for c in docs.columns])


def one_near_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that hang together by a shingle similarity of 0.8, the one with the least id stays."""
    return ngram_join.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which a benchmark item leaked go."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 1024 tokens."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path(TOKENIZER), window=1024, end_id=0)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", one_near_copy),
    ("decontamination", drop_leaks),
    ("packing", pack_tokens),
]

#: Models, edit distances and a tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
