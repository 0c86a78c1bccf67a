"""Registered queries: each reads the driver tables and returns a DataFrame.

``catalog.queries()`` maps a name to ``fn(spark, sf_dir) -> DataFrame``; ``catalog.oracle_sql()``
holds the ANSI SQL twin of each SQL-expressible one (for DuckDB on the same parquet files).
"""
