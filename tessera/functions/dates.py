"""Date and time functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_of_epoch(seconds: str | Column) -> Column:
    """UTC hour of an epoch-seconds value, independent of the session time zone."""
    return F.pmod(F.floor(_col(seconds) / 3600), F.lit(24)).cast("int")


def hour_of_timestamp(ts: str | Column) -> Column:
    """F08 for ``TIMESTAMP_NTZ`` (wall-clock) values."""
    return F.hour(_col(ts)).cast("int")


# The time-of-day bands of the source's comment, as half-open hour ranges.
TIME_BANDS = (
    ("morning", 7, 12),
    ("lunch", 12, 14),
    ("afternoon", 14, 18),
    ("evening", 18, 23),
)
OTHER_BAND = "night"


def time_of_day(hour: str | Column) -> Column:
    """the band containing ``hour``; hours outside every band are ``night``."""
    h = _col(hour)
    out = None
    for name, lo, hi in TIME_BANDS:
        cond = (h >= lo) & (h < hi)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out.otherwise(F.lit(OTHER_BAND))


def time_of_day_literal(hour: str | Column) -> Column:
    """F11 as the source's code runs it: its first test ``hour > 7`` wins, so only
    ``morning`` and ``night`` occur (D08)."""
    h = _col(hour)
    return (
        F.when(h > 7, "morning")
        .when(h > 12, "lunch")
        .when(h > 14, "afternoon")
        .when(h > 18, "evening")
        .otherwise("night")
    )


def iso_weekday(d: str | Column) -> Column:
    """ISO day of week, Monday = 1 .. Sunday = 7."""
    return (F.weekday(_col(d)) + 1).cast("int")


def weekend_flag(d: str | Column) -> Column:
    """1.0 for Saturday and Sunday, else 0.0."""
    return F.when(F.weekday(_col(d)) >= 5, F.lit(1.0)).otherwise(F.lit(0.0))
