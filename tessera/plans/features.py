"""Feature-building queries."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tessera.operators import features
from tessera.plans.registry import r6, register
from tessera.sources.tables import load

_TYPE_INDEX_SQL = """
    c AS (SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY event_type),
    m AS (SELECT event_type, row_number() OVER (ORDER BY n DESC, event_type) - 1 AS type_index FROM c)"""


@register(
    "category_index",
    sql=f"""
    WITH {_TYPE_INDEX_SQL}
    SELECT e.event_id, e.event_type, m.type_index FROM events e LEFT JOIN m ON e.event_type = m.event_type""",
)
def category_index(spark, sf_dir):
    """Event type -> index by descending frequency (ties alphabetical)."""
    ev = load(spark, sf_dir, "events").select("event_id", "event_type")
    return features.frequency_index(ev, "event_type", "type_index").select("event_id", "event_type", "type_index")


@register(
    "one_hot_size",
    sql=f"""
    WITH {_TYPE_INDEX_SQL},
    x AS (SELECT e.event_id, m.type_index FROM events e JOIN m ON e.event_type = m.event_type)
    SELECT event_id, type_index, CAST((SELECT max(type_index) FROM m) AS INTEGER) AS vec_size,
           CAST(CASE WHEN type_index < (SELECT max(type_index) FROM m) THEN type_index ELSE -1 END AS BIGINT) AS hot
    FROM x""",
)
def one_hot_size(spark, sf_dir):
    """One-hot vectors with the last category dropped: their size and the hot slot
    (-1 for the dropped category)."""
    ev = load(spark, sf_dir, "events").select("event_id", "event_type")
    indexed = features.frequency_index(ev, "event_type", "type_index").where(F.col("type_index").isNotNull())
    enc = features.one_hot(indexed.withColumn("type_idx", F.col("type_index").cast("double")), ["type_idx"])
    arr = vector_to_array("type_idx_vec")
    return enc.select(
        "event_id",
        "type_index",
        F.size(arr).cast("int").alias("vec_size"),
        (F.array_position(arr, 1.0) - 1).cast("long").alias("hot"),
    )


@register(
    "impute_mean",
    sql="""
    WITH t AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 0.0 ELSE c_acctbal END AS acctbal
               FROM customer)
    SELECT c_custkey,
           round(CASE WHEN acctbal = 0 THEN (SELECT avg(acctbal) FROM t WHERE acctbal <> 0) ELSE acctbal END, 6)
               AS acctbal_imputed
    FROM t""",
)
def impute_mean(spark, sf_dir):
    """0 marks a missing balance; replaced by the mean of the others (ML Imputer)."""
    c = load(spark, sf_dir, "customer")
    t = c.select("c_custkey", F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(0.0)).otherwise(F.col("c_acctbal")).alias("acctbal"))
    out = features.impute_mean(t, ["acctbal"], 0.0)
    return out.select("c_custkey", r6("acctbal").alias("acctbal_imputed"))


@register(
    "standardize",
    sql="""
    SELECT l_orderkey, l_linenumber,
           round((l_quantity - (SELECT avg(l_quantity) FROM lineitem)) / (SELECT stddev_samp(l_quantity) FROM lineitem), 6)
               AS z_quantity,
           round((l_discount - (SELECT avg(l_discount) FROM lineitem)) / (SELECT stddev_samp(l_discount) FROM lineitem), 6)
               AS z_discount
    FROM lineitem""",
)
def standardize(spark, sf_dir):
    """Assemble two columns and scale to mean 0, sample sd 1."""
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    assembled = features.assemble(li, ["l_quantity", "l_discount"], "raw")
    scaled = features.standardize(assembled, "raw", "z")
    arr = vector_to_array("z")
    return scaled.select("l_orderkey", "l_linenumber", r6(arr[0]).alias("z_quantity"), r6(arr[1]).alias("z_discount"))


_VOCAB_SQL = """
    v AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_id
          FROM (SELECT DISTINCT term FROM (SELECT unnest(string_split(p_name, ' ')) AS term FROM part)))"""


@register("vocabulary", sql=f"WITH {_VOCAB_SQL} SELECT term, term_id FROM v")
def vocabulary(spark, sf_dir):
    """Distinct words of the part names, numbered in word order."""
    return features.term_vocabulary(load(spark, sf_dir, "part"), "p_name", " ", "term_id").select("term", "term_id")


@register(
    "binary_bag",
    sql=f"""
    WITH {_VOCAB_SQL},
    p AS (SELECT DISTINCT p_partkey, term FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS term FROM part))
    SELECT p.p_partkey, v.term_id, CAST(1 AS DOUBLE) AS value FROM p JOIN v ON p.term = v.term""",
)
def binary_bag(spark, sf_dir):
    """The 0/1 term vector of each part name, as sparse (part, term id, 1)."""
    part = load(spark, sf_dir, "part").select("p_partkey", "p_name")
    vocab = features.term_vocabulary(part, "p_name", " ", "term_id")
    return features.binary_bag(part, "p_partkey", "p_name", vocab)
