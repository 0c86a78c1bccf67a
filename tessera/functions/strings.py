"""String functions (F01-F04, F06, M09 pattern)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word is two or more letters, digits or underscores in any script. Java's \w is ASCII
# unless (?U) is given and RE2 has no such switch, so the classes are spelled out; the
# pattern then tokenizes alike in Spark (Java regex) and in RE2-based engines.
WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"
_ONE_WORD_PAREN = r"\([\p{L}\p{N}_]+\)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_literal(c: str | Column, sep: str) -> Column:
    """split on a literal separator, keeping empty fields (like Python's ``str.split(sep)``)."""
    return F.split(_col(c), re.escape(sep), -1)


def parent_folder(path: str | Column) -> Column:
    """The second-to-last ``/`` component, e.g. the class folder of a document."""
    return F.try_element_at(split_literal(path, "/"), F.lit(-2))


def year_from_text(c: str | Column, missing: int = 1900) -> Column:
    """the last four characters as a year; ``missing`` when they are not a number (a sign and
    white space around it are allowed). The pattern keeps failing casts, which are slow, off the rest."""
    last = F.right(_col(c), F.lit(4))
    return F.coalesce(F.when(last.rlike(r"^\s*[+-]?[0-9]+\s*$"), last.try_cast("int")), F.lit(missing))


def title_without_parenthesis(c: str | Column) -> Column:
    """text before the first one-word parenthesis, trimmed; unchanged when there is none.

    ``Seven (Se7en) (1995)`` -> ``Seven``; ``A (b c) (1999)`` -> ``A (b c)``.
    """
    t = _col(c)
    head = F.regexp_extract(t, r"(?s)^(.*?)" + _ONE_WORD_PAREN, 1)
    return F.when(t.rlike(_ONE_WORD_PAREN), F.regexp_replace(head, r"^\s+|\s+$", "")).otherwise(t)


def strip_quotes(c: str | Column) -> Column:
    """remove every double quote."""
    return F.replace(_col(c), F.lit('"'), F.lit(""))


def tokens(c: str | Column, pattern: str = WORD_PATTERN) -> Column:
    """Lower-cased words of ``pattern`` (non-gap tokenizing), in text order."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(pattern), 0)

