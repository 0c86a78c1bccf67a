"""Numeric cleaning and math."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def number(c: str | Column) -> Column:
    """Text as a double, null where it is no number. The pattern keeps failing casts, which are slow,
    off dirty text; ``inf`` and ``nan`` are not numbers here."""
    return F.when(_col(c).rlike(_NUMBER), _col(c).try_cast("double"))


def clean_numeric(c: str | Column, unknown_marker: str = "?") -> Column:
    """quotes off; text holding ``unknown_marker`` -> 0.0; negative -> 0.0.

    Text that is not a number gives null (count those with :func:`rejected`), where the
    source raised. ``greatest`` is not used because it skips nulls.
    """
    text = F.replace(_col(c).cast("string"), F.lit('"'), F.lit(""))
    value = F.when(text.contains(unknown_marker), F.lit(0.0)).otherwise(number(text))
    return F.when(value < 0, F.lit(0.0)).otherwise(value)


def rejected(c: str | Column, unknown_marker: str = "?") -> Column:
    """1 where :func:`clean_numeric` could not parse a non-null input, else 0."""
    return F.when(_col(c).isNotNull() & clean_numeric(c, unknown_marker).isNull(), 1).otherwise(0)


def safe_half(c: str | Column) -> Column:
    """The value halved, null when the text is not a number (e.g. a postcode ``T8H1N``)."""
    return number(_col(c).cast("string")) / 2


def age_from_year(year: str | Column, base_year: int) -> Column:
    """``base_year - year``."""
    return (F.lit(base_year) - _col(year)).cast("int")


def squared_log_error(pred: str | Column, actual: str | Column) -> Column:
    """``(log(p + 1) - log(a + 1))^2``; RMSLE is ``sqrt(avg(.))`` of it."""
    return F.pow(F.log1p(_col(pred)) - F.log1p(_col(actual)), 2)
