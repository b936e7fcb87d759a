"""Whole texts as byte arrays inside Arrow tasks: words, word hashes and window hashes, without a Python loop per word.

A word is a run of characters other than space and 0x09-0x0D. All of these are single bytes in UTF-8, so words are
found on the encoded bytes. Hashes are 64 bits; equal sequences always hash alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18  # texts are hashed in runs of about this size; a longer text is a run of its own
_SEP = np.zeros(256, bool)
_SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C13 | 1
_INV = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (the splitmix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept for the next call up to the size of a usual run."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        out = np.full(max(n, 2 * CHUNK_BYTES), base, np.uint64)
        out[0] = 1
        have = np.cumprod(out, dtype=np.uint64)
        _powers[base] = have[: max(2 * CHUNK_BYTES, 0)].copy() if len(have) > 2 * CHUNK_BYTES else have
    return have[:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null has no bytes."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.fill_null("").cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int64)[column.offset: column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8)[offs[0]: offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


def runs(offs: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [i, j) of at most ``limit`` bytes each, or of one row."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1)
        yield i, j
        i = j


class Words:
    """Words of several texts: byte ``starts``/``ends``, 64-bit ``hashes`` and ``first`` (word index where each text starts)."""

    def __init__(self, raw: np.ndarray, offs: np.ndarray, lower: bool = False, hashed: bool = True,
                 separators: np.ndarray = _SEP):
        self.raw, self.offs = raw, offs
        b = _LOWER[raw] if lower else raw
        n = len(b)
        if n == 0:
            self.starts = self.ends = np.zeros(0, np.int64)
            self.hashes = np.zeros(0, np.uint64)
            self.first = np.zeros(len(offs), np.int64)
            self._total = np.zeros(1, np.uint64)
            return
        sep = separators[b]
        edge = np.zeros(n + 1, bool)
        edge[offs] = True
        before = np.empty(n, bool)  # a word can start here
        before[0] = True
        np.logical_or(sep[:-1], edge[1:n], out=before[1:])
        after = np.empty(n, bool)  # a word can end here
        after[-1] = True
        np.logical_or(sep[1:], edge[1:n], out=after[:-1])
        word = ~sep
        self.starts = np.flatnonzero(word & before)
        self.ends = np.flatnonzero(word & after) + 1
        self.first = np.searchsorted(self.starts, offs)
        if hashed:
            self._total = np.empty(n + 1, np.uint64)
            self._total[0] = 0
            np.cumsum(_VALUE[b] * _power(_BASE, n), out=self._total[1:])
            self.hashes = self._hash(self.ends)

    def _hash(self, ends: np.ndarray) -> np.ndarray:
        h = (self._total[ends] - self._total[self.starts]) * _power(_INV, max(1, len(self.raw)))[self.starts]
        return mix(h + (ends - self.starts).astype(np.uint64))

    def prefix_hashes(self, size: int) -> np.ndarray:
        """Hash of the first ``size`` bytes of each word (of the whole word, if shorter)."""
        return self._hash(np.minimum(self.ends, self.starts + size))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        """Row number of each word."""
        return np.repeat(np.arange(len(self.offs) - 1), self.counts())

    def window_starts(self, size: int) -> np.ndarray:
        """Indices of the words at which a window of ``size`` words of one text starts."""
        n = len(self.starts) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        r = self.rows()
        return np.flatnonzero(r[:n] == r[size - 1:])


def words_of(column: pa.Array, lower: bool = False, hashed: bool = True,
             separators: np.ndarray = _SEP) -> Iterator[tuple[int, int, Words]]:
    """(i, j, words of rows i..j-1) over runs of rows."""
    raw, offs = text_bytes(column)
    for i, j in runs(offs):
        yield i, j, Words(raw[offs[i]: offs[j]], offs[i: j + 1] - offs[i], lower, hashed, separators)


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive values (len - size + 1 of them, across text borders too)."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.empty(len(h) + 1, np.uint64)
    total[0] = 0
    np.cumsum(h * _power(_BASE, len(h)), out=total[1:])
    return mix((total[size:] - total[:-size]) * _power(_INV, n) + np.uint64(size))


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of raw[starts[i]: ends[i]] for each i."""
    n = len(raw)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(_VALUE[raw] * _power(_BASE, n), out=total[1:])
    return mix((total[ends] - total[starts]) * _power(_INV, n + 1)[starts] + (ends - starts).astype(np.uint64))


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)
