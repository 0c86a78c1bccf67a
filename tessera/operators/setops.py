"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def append_rows(*frames: DataFrame) -> DataFrame:
    """Bag union by position; names come from the first frame."""
    return reduce(DataFrame.union, frames)
