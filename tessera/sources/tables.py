"""Loader for the parquet tables (one folder holding ``<name>.parquet`` per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


#: A job that reads few large row groups may set this to a number of partitions; unset, tables are
#: read as they lie.
SCAN_PARTITIONS = "spark.tessera.scanPartitions"
#: Tables whose rows are texts, so that work on a row costs more than moving it.
_KEYS = {"documents": ("doc_id",), "pages": ("page_id",)}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazily scan one table. Column pruning and filters reach the parquet scan.

    Where the caller has set ``spark.tessera.scanPartitions``, the tables of texts are dealt by a hash of
    their key over that many partitions, so per-row work (tokenizing, stemming) on a table with few
    row groups does not run in one task; filters and projections stay below that exchange.
    """
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    wanted = spark.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(wanted), *_KEYS[name]) if wanted and name in _KEYS else df
