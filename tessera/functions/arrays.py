"""Array and vector functions (F15-F20, A16, P13), as higher-order SQL functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def array_mean(arr: str | Column) -> Column:
    """Mean of a numeric array (null for an empty one)."""
    a = _col(arr)
    total = F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return F.when(F.size(a) > 0, total / F.size(a))


def squared_distance(a: str | Column, b: str | Column) -> Column:
    """squared Euclidean distance of two equal-length numeric arrays."""
    diffs = F.zip_with(_col(a), _col(b), lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, d: acc + d)


def flags_to_names(flags: Sequence[tuple[str, Column]], sep: str | None = None) -> Column:
    """Names whose flag is true, in the given order (array, or joined with ``sep``)."""
    arr = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in flags]))
    return F.array_join(arr, sep) if sep is not None else arr
