"""Vectorised words, word hashes and n-gram hashes of Arrow text columns.

Words are the runs between the ASCII white space characters 0x20 and
0x09-0x0D. Tasks work on slices of half a megabyte of text, so that the arrays
built here stay small whatever the batch size; only a single very long text
makes a slice larger.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_M1, _M2 = _U(0xFF51AFD7ED558CCD), _U(0xC4CEB9FE1A85EC53)
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: All ASCII but digits and lower-case letters: between the words of lower-cased text without punctuation.
SYMBOLS = np.arange(256) < 128
SYMBOLS[[*range(0x30, 0x3A), *range(0x61, 0x7B)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> _U(33))
    x = x * _M1
    x = x ^ (x >> _U(33))
    x = x * _M2
    return x ^ (x >> _U(33))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD6E8FEB86659FD93))
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    if len(_powers[0]) < n:
        for k, b in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(n + n // 4 + 16, b, dtype=np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``limit`` bytes of text each."""
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total, start = np.cumsum(size + 1), 0
    while start < len(size):
        done = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, done + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end


class Words:
    """The words of some texts.

    ``data`` holds the texts' bytes, each followed by a space; ``start`` and
    ``end`` are the words' places in it; ``first[d]:first[d + 1]`` are the words
    of text ``d``. A null text has no words. ``breaks`` says which bytes stand
    between words, a space among them; ``lower`` lower-cases A-Z.
    """

    def __init__(self, texts: pa.Array, lower: bool = False, breaks: np.ndarray = _WHITE):
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        body = np.frombuffer(raw, dtype=np.uint8)[offsets[0]:offsets[-1]] if raw else np.zeros(0, np.uint8)
        size = np.diff(offsets)
        n = len(texts)
        self.bounds = np.concatenate([[0], np.cumsum(size + 1)])
        self.data = np.full(int(self.bounds[-1]), 0x20, dtype=np.uint8)
        place = np.ones(len(self.data), dtype=bool)
        place[self.bounds[1:] - 1] = False
        self.data[place] = body
        if lower:
            self.data = _LOWER[self.data]
        white = breaks[self.data]
        edge = np.diff(np.concatenate([[True], white]).astype(np.int8))
        self.start = np.flatnonzero(edge == -1)
        self.end = np.flatnonzero(edge == 1)
        self.first = np.searchsorted(self.start, self.bounds)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(n), self.count)

    def hashes(self) -> np.ndarray:
        """One 64-bit hash for each word, of its bytes alone."""
        base, inverse = _power_tables(len(self.data) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[self.data] * base[:len(self.data)])])
        return mix((total[self.end] - total[self.start]) * inverse[self.start] + (self.end - self.start).astype(np.uint64))

    def text(self, i: int, j: int) -> bytes:
        """Words ``i`` to ``j`` - 1 joined by one space."""
        return b" ".join(self.data[self.start[i]:self.end[j - 1]].tobytes().split()) if j > i else b""


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` hashes that begin at each place (the last n - 1 places have none)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(m, dtype=np.uint64)
    for k in range(n):
        out = out * _U(_BASE) + hashes[k:k + m]
    return mix(out)


def inside(words: Words, n: int) -> np.ndarray:
    """Which places of ``grams(.., n)`` lie within one text."""
    m = len(words.doc) - n + 1
    return words.doc[:m] == words.doc[n - 1:] if m > 0 else np.zeros(0, dtype=bool)
