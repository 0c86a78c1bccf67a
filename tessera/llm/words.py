"""Words of a column of texts, as numpy arrays inside one task.

Words are maximal runs of bytes that are not separators (white space by default), so a batch of
texts is cut without a Python loop: one lookup table says which bytes separate, a prefix sum of a
polynomial over the bytes gives a 64-bit hash of every word.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15 | 1
CHUNK = 1 << 19


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every bit of ``x`` reaches every bit of the result."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(n: int, salt: int = 0) -> np.ndarray:
    """``n`` fixed 64-bit numbers."""
    start = np.uint64((salt * 0x632BE59BD9B4E019 + 1) & MASK)
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(BASE) + start)


def pieces(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; a null is an empty text."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bytes_, at.astype(np.int64)


def chunks(at: np.ndarray, limit: int = CHUNK):
    """Ranges of texts of about ``limit`` bytes together; a longer text stands alone."""
    low, n = 0, len(at) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(at, at[low] + limit, "right")) - 1)
        yield low, min(high, n)
        low = min(high, n)


class Words(NamedTuple):
    first: np.ndarray  # of each text, the index of its first word; one entry more than texts
    begin: np.ndarray  # byte where each word begins, from the first text of the chunk
    end: np.ndarray
    hash: np.ndarray

    def texts(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


class WordHasher:
    """Cuts texts into words and hashes them. Built inside the task that uses it.

    ``separators``: bytes between words; ``fold``: A-Z count as a-z.
    """

    def __init__(self, separators: bytes = b" \t\n\r\x0b\x0c", fold: bool = False):
        self.between = np.zeros(256, bool)
        self.between[list(separators)] = True
        self.value = seeds(256, 7)
        if fold:
            self.value[65:91] = self.value[97:123]
        self.reach = 0

    def _grow(self, n: int) -> None:
        if n > self.reach:
            self.reach = max(n, CHUNK + (1 << 16))
            self.power = np.cumprod(np.full(self.reach, BASE, np.uint64))
            self.inverse = np.cumprod(np.full(self.reach, pow(BASE, -1, 1 << 64), np.uint64))

    def cut(self, data: np.ndarray, at: np.ndarray) -> Words:
        """Words of the texts that ``at`` bounds in ``data``."""
        b = data[at[0] : at[-1]]
        n = len(b)
        if n == 0:
            none = np.zeros(0, np.int64)
            return Words(np.zeros(len(at), np.int64), none, none, np.zeros(0, np.uint64))
        self._grow(n)
        inside = ~self.between[b]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        edge = at - at[0]
        inner = edge[(edge > 0) & (edge < n)]
        opens[inner] = inside[inner]
        closes[inner - 1] = inside[inner - 1]
        begin, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(self.value[b] * self.power[:n], out=total[1:])
        code = mix64((total[end] - total[begin]) * self.inverse[begin])
        return Words(np.searchsorted(begin, edge), begin, end, code)


def windows(code: np.ndarray, width: int, salt: int = 0) -> np.ndarray:
    """Hash of ``width`` successive word hashes from every position that has as many."""
    n = len(code) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    factor = seeds(width, 100 + salt) | np.uint64(1)
    out = code[:n] * factor[0]
    for j in range(1, width):
        out += code[j : j + n] * factor[j]
    return mix64(out)


def long_windows(code: np.ndarray, width: int, salt: int = 0) -> np.ndarray:
    """As ``windows``, by a prefix sum, so that the cost does not grow with ``width``."""
    n = len(code) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base = (int(seeds(1, 200 + salt)[0]) | 1) & MASK
    power = np.cumprod(np.full(len(code), base, np.uint64))
    back = np.cumprod(np.full(n, pow(base, -1, 1 << 64), np.uint64))
    total = np.zeros(len(code) + 1, np.uint64)
    np.cumsum(code * power, out=total[1:])
    return mix64((total[width:] - total[:n]) * back)


def shingles(words: Words, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``width``-word runs, and the text each belongs to, in text order.

    A text of fewer words, but at least one, has one shingle: all its words.
    """
    count = np.diff(words.first)
    if len(words.hash) >= width:
        code = windows(words.hash, width)
        text = words.texts()
        whole = text[: len(code)] == text[width - 1 :]
        code, text = code[whole], text[: len(whole)][whole]
    else:
        code, text = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        own = [windows(words.hash[words.first[i] : words.first[i + 1]], int(count[i]), salt=9)[0] for i in short]
        code, text = np.concatenate([code, np.array(own, np.uint64)]), np.concatenate([text, short])
        order = np.argsort(text, kind="stable")
        code, text = code[order], text[order]
    return code, text
