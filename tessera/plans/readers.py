"""Readers under an oracle (S01-S07, S11): a given table is written in each layout below the shared
folder and read back with the library's reader; the twin reads the parquet table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.plans.registry import register
from tessera.sources import readers
from tessera.sources.tables import load
from tessera.streaming.streams import scratch_dir


def _joined(df, sep):
    """One text column: the fields of each row between separators."""
    return df.select(F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]).alias("value"))


def _written(df, name):
    path = scratch_dir(df.sparkSession, f"layout-{name}")
    df.write.text(path)
    return path


@register("read_text_lines", sql="SELECT c_name AS value FROM customer")
def read_text_lines(spark, sf_dir):
    """One row per line."""
    lines = load(spark, sf_dir, "customer").select(F.col("c_name").alias("value"))
    return readers.text_lines(spark, _written(lines, "lines"))


@register("read_pipe", sql="SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def read_pipe(spark, sf_dir):
    """Pipe-delimited fields, no quoting."""
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return readers.delimited(spark, _written(_joined(c, "|"), "pipe"), c.schema, "|")


@register("read_tab", sql="SELECT o_custkey, o_orderkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice FROM orders")
def read_tab(spark, sf_dir):
    """Tab-delimited fields."""
    o = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", F.round("o_totalprice", 6).alias("o_totalprice"))
    return readers.delimited(spark, _written(_joined(o, "\t"), "tab"), o.schema, "\t")


@register("read_double_colon", sql="SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def read_double_colon(spark, sf_dir):
    """Fields separated by ``::``."""
    s = load(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return readers.delimited(spark, _written(_joined(s, "::"), "colon"), s.schema, "::")


@register("read_quoted_tsv", sql="SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand || ' \"x\"' AS brand FROM part")
def read_quoted_tsv(spark, sf_dir):
    """Tab-separated, quoted values with quotes inside, first line the header; all strings."""
    p = load(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("p_partkey"), "p_name", F.concat("p_brand", F.lit(' "x"')).alias("brand")
    )
    path = scratch_dir(spark, "layout-tsv")
    p.write.option("sep", "\t").option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    return readers.quoted_tsv(spark, path)


@register("read_csv_header", sql="SELECT o_orderkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice FROM orders")
def read_csv_header(spark, sf_dir):
    """Comma-separated with a header."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.round("o_totalprice", 6).alias("o_totalprice"))
    path = scratch_dir(spark, "layout-csv")
    o.write.option("header", True).csv(path)
    return readers.csv_with_header(spark, path, o.schema)


@register(
    "read_whole_files",
    sql="""
    SELECT 'month=' || strftime(o_orderdate, '%Y-%m') AS folder,
           string_agg(CAST(o_orderkey AS VARCHAR) || chr(10), '' ORDER BY o_orderkey) AS text
    FROM orders GROUP BY 1""",
)
def read_whole_files(spark, sf_dir):
    """One row per file, the class from its folder: the orders of each month, one key a line."""
    o = load(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderkey")
    path = scratch_dir(spark, "layout-files")
    lines = o.repartition("month").sortWithinPartitions("month", "o_orderkey")  # one file a month, in order
    lines.select("month", F.col("o_orderkey").cast("string").alias("value")).write.partitionBy("month").text(path)
    files = readers.whole_files(spark, f"{path}/*/*.txt")
    return files.select(F.element_at(F.split("path", "/"), -2).alias("folder"), "text")


@register(
    "inline_dimension",
    sql="""
    WITH d AS (SELECT * FROM (VALUES ('F', 'finished', 2), ('O', 'open', 0), ('P', 'partial', 1)) v(status, name, place))
    SELECT coalesce(d.name, 'unknown') AS name, d.place, count(*) AS n, round(sum(o.o_totalprice), 2) AS total
    FROM orders o LEFT JOIN d ON d.status = o.o_orderstatus GROUP BY 1, 2""",
)
def inline_dimension(spark, sf_dir):
    """A small table given as rows, joined to the orders."""
    names = readers.inline_rows(spark, [("F", "finished", 2), ("O", "open", 0), ("P", "partial", 1)], "status string, name string, place int")
    o = load(spark, sf_dir, "orders").join(names, F.col("o_orderstatus") == F.col("status"), "left")
    return o.groupBy(F.coalesce("name", F.lit("unknown")).alias("name"), "place").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )
