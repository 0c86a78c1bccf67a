"""Porter's suffix-stripping stemmer (M. F. Porter, "An algorithm for suffix stripping",
Program 14(3), 1980) as SQL expressions over a column.

Each step is one expression over the word ``w``; consonant and vowel runs are regular
expressions, with a first ``y`` written as ``Y`` so that it counts as a consonant. The text is
plain SQL but for the name of the regular-expression predicate, so any engine can run it.
``stem_of`` has the same steps for one word; a task stems the words of its arrays by it, each once.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rule tables of the published algorithm (suffix, replacement), in the
# paper's order.
STEP2_RULES = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
)
STEP3_RULES = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
)
STEP4_SUFFIXES = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion",
    "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)

_C, _V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
_ONE = f"^({_C})?{_V}{_C}"  # measure of 1 and more
_JUST_ONE = f"^({_C})?{_V}{_C}({_V})?$"
_TWO = f"^({_C})?{_V}{_C}{_V}{_C}"  # measure of 2 and more
_VOWEL = f"^({_C})?[aeiouy]"
_CVC = f"^{_C}[aeiouy][^aeiouwxy]$"


def steps(matches: str = "regexp_like", ends_with: str = "endswith") -> list[str]:
    """The algorithm's steps, each an expression of ``w`` that gives the next ``w``. ``matches`` and
    ``ends_with``: the engine's functions of (text, pattern) and (text, ending)."""
    rx = lambda text, pattern: f"{matches}({text}, '{pattern}')"
    stem = lambda n: f"substr(w, 1, length(w) - {n})"
    ends = lambda suffix: f"{ends_with}(w, '{suffix}')"

    def longest_first(rules, measure):
        cases = [
            f"WHEN {ends(s)} THEN CASE WHEN {rx(stem(len(s)), measure)} THEN concat({stem(len(s))}, '{r}') ELSE w END"
            for s, r in sorted(rules, key=lambda rule: -len(rule[0]))
        ]
        return f"CASE {' '.join(cases)} ELSE w END"

    def step4():
        cases = []
        for s in sorted(STEP4_SUFFIXES, key=lambda x: -len(x)):
            also = f" AND {rx(stem(len(s)), '[st]$')}" if s == "ion" else ""
            cases.append(f"WHEN {ends(s)} THEN CASE WHEN {rx(stem(len(s)), _TWO)}{also} THEN {stem(len(s))} ELSE w END")
        return f"CASE {' '.join(cases)} ELSE w END"

    # after ed or ing has gone, marked by a trailing '-'
    marked = ends("-")
    double = f"{marked} AND {rx('w', '[^aeiouylsz]-$')} AND substr(w, length(w) - 1, 1) = substr(w, length(w) - 2, 1)"
    return [
        "CASE WHEN substr(w, 1, 1) = 'y' THEN concat('Y', substr(w, 2)) ELSE w END",
        f"CASE WHEN {ends('sses')} OR {ends('ies')} THEN {stem(2)} WHEN {ends('ss')} THEN w WHEN {ends('s')} THEN {stem(1)} ELSE w END",
        f"CASE WHEN {ends('eed')} THEN CASE WHEN {rx(stem(3), _ONE)} THEN {stem(1)} ELSE w END "
        f"WHEN {ends('ed')} AND {rx(stem(2), _VOWEL)} THEN concat({stem(2)}, '-') "
        f"WHEN {ends('ing')} AND {rx(stem(3), _VOWEL)} THEN concat({stem(3)}, '-') ELSE w END",
        f"CASE WHEN {marked} AND {rx('w', '(at|bl|iz)-$')} THEN concat({stem(1)}, 'e') WHEN {double} THEN {stem(2)} "
        f"WHEN {marked} AND {rx(stem(1), _JUST_ONE)} AND {rx(stem(1), '[^aeiou][aeiouy][^aeiouwxy]$')} THEN concat({stem(1)}, 'e') "
        f"WHEN {marked} THEN {stem(1)} ELSE w END",
        f"CASE WHEN {ends('y')} AND {rx(stem(1), _VOWEL)} THEN concat({stem(1)}, 'i') ELSE w END",
        longest_first(STEP2_RULES, _ONE),
        longest_first(STEP3_RULES, _ONE),
        step4(),
        f"CASE WHEN {ends('e')} AND ({rx(stem(1), _TWO)} OR ({rx(stem(1), _JUST_ONE)} AND NOT {rx(stem(1), _CVC)})) THEN {stem(1)} ELSE w END",
        f"CASE WHEN {ends('ll')} AND {rx('w', _TWO)} THEN {stem(1)} ELSE w END",
        "CASE WHEN substr(w, 1, 1) = 'Y' THEN concat('y', substr(w, 2)) ELSE w END",
    ]


#: Words that are stemmed; shorter ones and those with other signs stay as they are.
STEMMED = "^[a-z]{3,}$"


def with_stem(words: DataFrame, word: str, out: str = "stem") -> DataFrame:
    """``words`` with the Porter stem of the lower-case column ``word``."""
    df = words.withColumn("w", F.col(word))
    for step in steps():
        df = df.withColumn("w", F.expr(step))
    return df.withColumn(out, F.when(F.col(word).rlike(STEMMED), F.col("w")).otherwise(F.col(word))).drop("w")


_has = {name: re.compile(pattern).search for name, pattern in (
    ("stemmed", STEMMED), ("one", _ONE), ("just one", _JUST_ONE), ("two", _TWO), ("vowel", _VOWEL), ("cvc", _CVC),
    ("short", "[^aeiou][aeiouy][^aeiouwxy]$"),
)}


def _without_suffix(w: str, rules, measure) -> str:
    """The longest of ``rules`` (suffix, replacement) that ``w`` ends with, applied if ``measure`` allows it."""
    for suffix, other in rules:
        if w.endswith(suffix):
            return w[: -len(suffix)] + other if measure(w[: -len(suffix)], suffix) else w
    return w


_LONGEST_FIRST = [sorted(rules, key=lambda rule: -len(rule[0])) for rules in (STEP2_RULES, STEP3_RULES, [(s, "") for s in STEP4_SUFFIXES])]


@lru_cache(1 << 18)
def stem_of(w: str) -> str:
    """The Porter stem of one lower-case word, as :func:`with_stem` gives it."""
    if not _has["stemmed"](w):
        return w
    if w[0] == "y":
        w = "Y" + w[1:]
    if w.endswith(("sses", "ies")):
        w = w[:-2]
    elif w.endswith("s") and not w.endswith("ss"):
        w = w[:-1]
    cut = 0
    if w.endswith("eed"):
        w = w[:-1] if _has["one"](w[:-3]) else w
    elif w.endswith("ed") and _has["vowel"](w[:-2]):
        cut = 2
    elif w.endswith("ing") and _has["vowel"](w[:-3]):
        cut = 3
    if cut:
        w = w[:-cut]
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif w[-1] not in "aeiouylsz" and w[-1] == w[-2:-1]:
            w = w[:-1]
        elif _has["just one"](w) and _has["short"](w):
            w += "e"
    if w.endswith("y") and _has["vowel"](w[:-1]):
        w = w[:-1] + "i"
    for rules in _LONGEST_FIRST[:2]:
        w = _without_suffix(w, rules, lambda s, suffix: _has["one"](s))
    w = _without_suffix(w, _LONGEST_FIRST[2], lambda s, suffix: _has["two"](s) and (suffix != "ion" or s.endswith(("s", "t"))))
    if w.endswith("e") and (_has["two"](w[:-1]) or (_has["just one"](w[:-1]) and not _has["cvc"](w[:-1]))):
        w = w[:-1]
    if w.endswith("ll") and _has["two"](w):
        w = w[:-1]
    return "y" + w[1:] if w[:1] == "Y" else w


def _stem_arrays(words: pa.Array) -> pa.Array:
    flat = words.flatten().dictionary_encode()
    stems = pa.array([stem_of(w) for w in flat.dictionary.to_pylist()], pa.string())
    size = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    first = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
    return pa.ListArray.from_arrays(first, stems.take(flat.indices), mask=words.is_null())


def stems_of(words: str) -> Column:
    """The Porter stems of an array of lower-case words, in their places: no word leaves its row. Of the rows
    that come together each different word is stemmed once, and a worker remembers the last 262,144.
    A null array or word stays null."""
    return F.arrow_udf(_stem_arrays, "array<string>")(F.expr(words))


def stem_sql(source: str, word: str, matches: str) -> str:
    """The same as a SELECT over the relation ``source``: all its columns and ``stem``."""
    inner = f"(SELECT *, {word} AS w FROM {source})"
    for step in steps(matches, "ends_with"):
        inner = f"(SELECT * REPLACE ({step} AS w) FROM {inner})"
    return f"SELECT * EXCLUDE (w), CASE WHEN {matches}({word}, '{STEMMED}') THEN w ELSE {word} END AS stem FROM {inner}"
