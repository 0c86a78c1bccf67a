"""Registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.llm import (
    conversations,
    decontaminate,
    fim,
    gam,
    line_dedup,
    merkle,
    ngram_join,
    packing,
    pii,
    suffix_dedup,
    toxicity,
    url_filter,
    warc,
)
from tessera.llm.oracles import SQL  # noqa: F401
from tessera.llm.stage import shared_folder, table

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_warc_dictionary(spark, sf_dir):
    """Every page written to dictionary-compressed archives and read back."""
    pages = table(spark, sf_dir, "pages")
    path = shared_folder(spark, "warc")
    warc.write_archives(warc.with_record_types(pages), path, warc.train_dictionary(warc.payloads(pages)))
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op2_gam_quality(spark, sf_dir):
    """Every document scored for quality."""
    docs = table(spark, sf_dir, "documents")
    return gam.scored(docs, gam.train(docs, table(spark, sf_dir, "labels")))


#: The rules of the query's contract.
RULES = [
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]


@query
def op3_url_redirects(spark, sf_dir):
    """Every page's url judged by rules and by its aliases."""
    return url_filter.judge(table(spark, sf_dir, "pages"), RULES)


@query
def op4_line_dedup(spark, sf_dir):
    """Every document without the lines that an earlier line repeats, and how many stayed."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_repeated_lines(docs)


@query
def op5_suffix_dedup(spark, sf_dir):
    """The passages of 50 words and more that documents share, each with the number of its words
    that an earlier document has too."""
    found = suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"))
    within = F.expr(
        "aggregate(filter(later, x -> x.begin >= p.begin and x.end <= p.end), 0L, (n, x) -> n + x.end - x.begin)"
    )
    return found.select("doc_id", "later", F.explode("passages").alias("p")).select(
        "doc_id", F.col("p.begin").alias("first_word"), F.col("p.end").alias("end_word"), within.alias("later_words")
    )


@query
def op6_kn_toxicity(spark, sf_dir):
    """Every document scored for toxicity."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query
def op7_jaccard_join(spark, sf_dir):
    """Every document's class of near copies and its number of links."""
    return ngram_join.near_links(table(spark, sf_dir, "documents"))


@query
def op8_merkle_fingerprint(spark, sf_dir):
    """Every document's fingerprint, that of its edited text, and how like they are."""
    return merkle.edited_likeness(table(spark, sf_dir, "documents"))


@query
def op9_nnls_packing(spark, sf_dir):
    """Every document packed into windows of 1024 tokens."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(table(spark, sf_dir, "documents"), path, window=1024, end_id=0)


@query
def op10_lsi_decontamination(spark, sf_dir):
    """Every document into which a benchmark item leaked, with the item."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_conversation_repair(spark, sf_dir):
    """Every conversation damaged by rule and mended by the cheapest edits."""
    return conversations.damaged_and_repaired(table(spark, sf_dir, "conversations"))


@query
def op12_personal_data(spark, sf_dir):
    """Every document's spans of personal data."""
    return pii.digests(table(spark, sf_dir, "documents"))


@query
def op13_fill_in_middle(spark, sf_dir):
    """Every document cut into prefix, middle and suffix, and put together again."""
    return fim.digests(table(spark, sf_dir, "documents"), rate=100, spm=50, seed=7)
