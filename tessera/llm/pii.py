"""Personal data: regular expressions propose spans, checksums confirm them, words nearby adjust the score.

Base kinds: ``email``, ``ip`` (parts at most 255), ``card`` (14 to 19 digits that pass Luhn) and ``phone``
(a plus sign, 10 to 15 digits). Their matches are taken left to right without overlap and stay
whatever their score. Further kinds are kept from a score of 0.6 where they overlap nothing that is
kept already: ``iban`` (confirmed by mod 97 and its country's length), ``ssn`` (three, two and four digits
in the ranges that are issued) and ``tel`` (a phone number without a plus sign). The last two need a
word nearby that speaks for them, and words such as "order" or "version" speak against them.

Spans are code points, end exclusive. No pattern rescans a run of characters that it has failed on,
so the time is linear in the text.

Defined results: a null text is the empty one, which has no spans; rows of one id stand for
themselves; other columns are left out.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "tel")
LEAST_SCORE = 0.6
REACH = 48

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
# a run of characters that no match begins in is taken whole, so that it is not tried again from its middle
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"[0-9]++(\.[0-9]++\.[0-9]++\.[0-9]++)?")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=[ -]?[A-Z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_TEL = re.compile(r"(?<![0-9A-Za-z+.(-])\(?[0-9]{2,5}\)?(?:[ ./-]?[0-9]{2,5}){2,4}(?![0-9A-Za-z])")
_DATE = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}([./])[0-9]{2}\1[0-9]{4}")
_WORD = re.compile(r"[^\W\d_]+")

#: Characters of an account number by country.
IBAN_LENGTH = {
    "AD": 24, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18,
    "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21,
    "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27,
    "TR": 26,
}
#: Words nearby that speak for a kind.
FOR = {
    "email": {"email", "mail", "contact", "courriel", "correo"},
    "ip": {"ip", "address", "host", "server", "client", "adresse", "login"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "debit", "carte", "karte", "tarjeta", "payment"},
    "phone": {"phone", "tel", "telephone", "call", "mobile", "cell", "fax", "téléphone", "telefon", "teléfono", "móvil", "handy"},
    "iban": {"iban", "account", "bank", "konto", "compte", "cuenta"},
    "ssn": {"ssn", "social", "security", "sozialversicherung", "sécurité", "seguridad"},
}
FOR["tel"] = FOR["phone"]
#: Words nearby that speak against numbers being personal.
AGAINST = {"order", "invoice", "version", "isbn", "serial", "part", "ref", "reference", "bestellung", "facture", "pedido"}
#: Scores without words nearby; a checksum or a closed form confirms the first four kinds and iban.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.4, "tel": 0.3}


class Span(NamedTuple):
    kind: str
    begin: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    """Of the digits from the right every second is doubled; the digits of all add up to a multiple of ten."""
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def mod97(account: str) -> bool:
    """The first four characters moved to the end, letters as 10 to 35: the remainder by 97 is 1."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def _emails(text: str):
    least = at = 0  # where the next match may begin, and where an @ is looked for
    while (q := text.find("@", at)) >= 0:
        before = text[least:q]
        local = len(before) - len(before.rstrip(LOCAL))
        if local and (m := _DOMAIN.match(text, q + 1)):
            yield q - local, m.end()
            least = at = m.end()
        else:
            least = at = q + 1


def _ips(text: str):
    for m in _IP.finditer(text):
        if m[1] is not None:
            parts = [p.lstrip("0") for p in m[0].split(".")]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                yield m.span()


def _cards(text: str):
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str):
    for m in _PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            yield m.span()


def _ibans(text: str):
    for m in _IBAN.finditer(text):
        size = IBAN_LENGTH.get(m[0][:2])
        if size is None:
            continue
        own, at = [], m.start()
        while len(own) < size and at < len(text):
            c = text[at]
            if c in " -" and own and at + 1 < len(text) and text[at + 1].isascii() and text[at + 1].isalnum():
                at += 1
                continue
            if not (c.isascii() and (c.isdigit() or c.isupper())):
                break
            own.append(c)
            at += 1
        ends = at == len(text) or not (text[at].isascii() and text[at].isalnum())
        if len(own) == size and ends and mod97("".join(own)):
            yield m.start(), at


def _ssns(text: str):
    for m in _SSN.finditer(text):
        yield m.span()


def _tels(text: str):
    for m in _TEL.finditer(text):
        if 7 <= sum(c.isdigit() for c in m[0]) <= 15 and not _DATE.search(m[0]):
            yield m.span()


def _score(text: str, kind: str, begin: int, end: int) -> float:
    near = text[max(0, begin - REACH) : begin] + " " + text[end : end + REACH // 2]
    words = {w.lower() for w in _WORD.findall(near)}
    score = PRIOR[kind] + 0.4 * bool(words & FOR[kind])
    if kind != "email":
        score -= 0.3 * bool(words & AGAINST)
    return round(min(1.0, max(0.0, score)), 6)


_BASE = {"email": _emails, "ip": _ips, "card": _cards, "phone": _phones}
_MORE = {"iban": _ibans, "ssn": _ssns, "tel": _tels}


def spans(text: str) -> list[Span]:
    """All spans by begin, then kind as listed."""
    kept = [Span(k, b, e, 0.0) for k, find in _BASE.items() if k == "email" or _has_digit(text) for b, e in find(text)]
    kept = [s._replace(score=_score(text, *s[:3])) for s in kept]
    more = []
    if _has_digit(text):
        for k, find in _MORE.items():
            for b, e in find(text):
                score = _score(text, k, b, e)
                if score >= LEAST_SCORE:
                    more.append(Span(k, b, e, score))
    if more:
        taken = _Taken(kept)
        for s in sorted(more, key=lambda s: (-s.score, KINDS.index(s.kind), s.begin)):
            if taken.free(s):
                kept.append(s)
    return sorted(kept, key=lambda s: (s.begin, KINDS.index(s.kind)))


_DIGIT = re.compile(r"[0-9]")


def _has_digit(text: str) -> bool:
    return _DIGIT.search(text) is not None


class _Taken:
    """Places that spans hold, by blocks of 64."""

    def __init__(self, held: list[Span]):
        self.by: dict[int, list[Span]] = {}
        for s in held:
            self._put(s)

    def _put(self, s: Span) -> None:
        for k in range(s.begin >> 6, (s.end - 1 >> 6) + 1):
            self.by.setdefault(k, []).append(s)

    def free(self, s: Span) -> bool:
        for k in range(s.begin >> 6, (s.end - 1 >> 6) + 1):
            if any(s.begin < x.end and x.begin < s.end for x in self.by.get(k, ())):
                return False
        self._put(s)
        return True


FOUND = "array<struct<kind:string,begin:long,end:long,score:double>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def found(docs: DataFrame) -> DataFrame:
    """doc_id and ``spans`` of every whole text: kind, begin, end and score."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def find(batches):
        for batch in batches:
            # one text at a time: a batch of very long texts is not held twice
            rows = [[s._asdict() for s in spans(t.as_py())] for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(rows, _SPANS)], ["doc_id", "spans"])

    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(find, f"doc_id {kind}, spans {FOUND}")


def listed(every: Column) -> Column:
    """``kind:begin:end`` of spans, comma-joined."""
    return F.array_join(F.transform(every, lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))), ",")


def digests(docs: DataFrame) -> DataFrame:
    """Per document the number of base spans of each kind, the SHA-256 of their list and the list of all."""
    rows = found(docs)
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return rows.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(listed(of(*BASE)), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
    )
