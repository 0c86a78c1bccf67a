"""Fill-in-middle transformation: a text is cut into prefix, middle and suffix at the ends of lines.

One ``fullmatch`` of the regex library of ``(line)*`` keeps every repetition of its group, so
``match.ends(1)`` is the list of all line ends: its length is the number of lines and two look-ups
give both cuts. Where the cuts fall, whether a text is transformed at all and in which order the
parts come is read from a SHA-256 of the document's id.

Forms: ``plain`` (the text itself), ``psm`` (``<P>`` prefix ``<S>`` suffix ``<M>`` middle) and ``spm``
(``<S>`` suffix ``<P>`` prefix ``<M>`` middle). A transformed text holds no marker of its own, so the
output and its form give the text back (``restored``).

Defined results: a null text is the empty one; empty texts and texts that hold a marker stay plain;
a null id counts as an empty one; the other columns of the table stay, those that the operator
makes replace any of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKERS = ("<P>", "<S>", "<M>")
LINES = r"([^\n]*+\n|[^\n]++)*+"
MADE = "struct<n:long,form:string,prefix_chars:long,middle_chars:long,output:string>"


def cut(text: str, lines, numbers: tuple, rate: int, spm: int) -> tuple:
    """Lines, form, lengths of prefix and middle, output. ``lines``: the compiled pattern; ``numbers``: four
    of the document's own."""
    ends = lines.fullmatch(text).ends(1)
    n = len(ends)
    if not text or any(m in text for m in MARKERS) or numbers[2] % 100 >= rate:
        return n, "plain", None, None, text
    places = sorted(x % (n + 1) for x in numbers[:2])
    a, b = (ends[p - 1] if p else 0 for p in places)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if numbers[3] % 100 < spm:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def transformed(docs: DataFrame, rate: int = 100, spm: int = 50, seed: int = 7) -> DataFrame:
    """``docs`` with ``n`` (lines), ``form``, ``prefix_chars``, ``middle_chars`` (code points; null if plain)
    and ``output``. ``rate``: per cent of texts that are transformed; ``spm``: per cent of these with the
    suffix first."""

    @F.pandas_udf(MADE)
    def make(text, digest):
        import pandas as pd
        import regex

        lines = regex.compile(LINES)
        numbers = (tuple(int(d[i : i + 8], 16) for i in range(0, 32, 8)) for d in digest)
        rows = [cut(t, lines, k, rate, spm) for t, k in zip(text, numbers, strict=True)]
        made = pd.DataFrame(rows, columns=["n", "form", "prefix_chars", "middle_chars", "output"])
        return made.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    made = make(F.coalesce("text", F.lit("")), F.sha2(named, 256))
    new = ["n", "form", "prefix_chars", "middle_chars", "output"]
    old = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in new]
    return docs.select(F.struct(*old).alias("_docs"), made.alias("_made")).select("_docs.*", "_made.*")


def restored(output: Column, form: Column) -> Column:
    """The text that was transformed."""
    part = F.split(output, "<[PSM]>", -1)
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(part[1], part[3], part[2]))
        .otherwise(F.concat(part[2], part[3], part[1]))
    )


def digests(docs: DataFrame, **parameters) -> DataFrame:
    """Per document the cut and SHA-256 of the output and of the text rebuilt from it."""
    out = transformed(docs.select("doc_id", "text"), **parameters)
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"),
        sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )
