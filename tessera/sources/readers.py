"""Text and delimited readers with declared schemas.

All return DataFrames; nothing is parsed in Python. Delimited files are read by the CSV
source so that Spark splits large files, prunes columns and never infers a schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def delimited(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    sep: str,
    encoding: str = "UTF-8",
    header: bool = False,
) -> DataFrame:
    """``|``, tab or multi-character (``::``) separated fields, no quoting.

    Blank lines are skipped by the CSV source; malformed numbers become null.
    """
    return (
        spark.read.option("sep", sep)
        .option("quote", "")
        .option("header", header)
        .option("encoding", encoding)
        .option("mode", "PERMISSIVE")
        .schema(schema)
        .csv(path)
    )


def quoted_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated, quoted values, first line is the header; all columns strings.

    The header is dropped by the reader (only the first line, unlike a filter on equality).
    """
    return (
        spark.read.option("sep", "\t")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("inferSchema", False)
        .csv(path)
    )


def csv_with_header(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Comma-separated with a header; declared schema when given, else all strings."""
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def whole_files(spark: SparkSession, path_glob: str) -> DataFrame:
    """One row per file, ``(path, text)``."""
    return spark.read.text(path_glob, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
    )


def inline_rows(spark: SparkSession, rows, schema) -> DataFrame:
    """Small literal tables (tests, dimension stubs)."""
    return spark.createDataFrame(rows, schema)


def integer_range(spark: SparkSession, n: int, name: str = "id") -> DataFrame:
    """``0 .. n-1`` as one column, generated in parallel."""
    return spark.range(n).toDF(name)
