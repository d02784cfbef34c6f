"""Vectorised word and shingle hashing over Arrow string columns.

Works on the UTF-8 bytes of a whole record batch at once.  Word separators in
every contract here are ASCII, so a byte below 0x80 decides alone and bytes of
multi-byte characters always belong to words.  Texts are never cut: a slice
always holds whole rows, however long one row is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE_BYTES = 1 << 18          # rows are hashed in slices of about this many bytes
_GOLD = 0x9E3779B97F4A7C15     # 2^64 / golden ratio, the usual odd mixing constant
_POLY = U64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift / multiply), element-wise."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


_BYTE_VALUE = mix((np.arange(256, dtype=U64) + U64(1)) * U64(_GOLD))
_LANE = mix(np.arange(1, 9, dtype=U64) * U64(0xA0761D6478BD642F)) | U64(1)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A 256-entry table that is False exactly for the given byte ranges."""
    t = np.ones(256, dtype=bool)
    for lo, hi in ranges:
        t[lo:hi + 1] = False
    return t


NON_SPACE = byte_class((0x20, 0x20), (0x09, 0x0D))
ALNUM = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def string_parts(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty.
    ``offsets[i]:offsets[i+1]`` is row i in ``bytes``."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    n = len(col)
    _, off, data = col.buffers()
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, np.int64, n + 1, col.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes, one row at least."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def span_hash(chars: np.ndarray, lengths: np.ndarray, lower: bool = False) -> np.ndarray:
    """Hash of each of the consecutive, non-empty spans that ``chars`` consists of."""
    if not len(chars):
        return np.zeros(0, U64)
    at = np.zeros(len(lengths), np.int64)
    np.cumsum(lengths[:-1], out=at[1:])
    inside = np.arange(len(chars)) - np.repeat(at, lengths)
    powers = np.empty(int(lengths.max()), U64)
    powers[0] = 1
    powers[1:] = _POLY
    np.multiply.accumulate(powers, out=powers)
    value = _BYTE_VALUE[_LOWER] if lower else _BYTE_VALUE
    total = np.add.reduceat(value[chars] * powers[inside], at)
    return mix(total ^ (lengths.astype(U64) * U64(_GOLD)))


class Words:
    """The words of some rows: ``hash`` per word, ``first[i]:first[i+1]`` the
    words of row i, ``start``/``end`` byte positions."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray, lower: bool):
        n_rows = len(offsets) - 1
        is_word = table[data] if not lower else table[_LOWER][data]
        begin, last = is_word.copy(), is_word.copy()
        if len(data):
            begin[1:] &= ~is_word[:-1]
            last[:-1] &= ~is_word[1:]
            full = offsets[:-1] < offsets[1:]
            heads, tails = offsets[:-1][full], offsets[1:][full] - 1
            begin[heads] = is_word[heads]
            last[tails] = is_word[tails]
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.start, offsets).astype(np.int64)
        self.n_rows = n_rows
        self.length = self.end - self.start
        self.hash = span_hash(data[is_word], self.length, lower)

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_rows), np.diff(self.first))


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive entries of ``h`` (ignores rows)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    total = np.zeros(n, U64)
    for j in range(k):
        total += h[j:j + n] * _LANE[j]
    return mix(total + U64(k))


def row_shingles(words: Words, row: int, wins: np.ndarray, k: int = 5) -> np.ndarray:
    """Sorted distinct ``k``-word shingles of a row; a shorter row is one
    shingle of all its words, a row without words has none.  ``wins`` are the
    ``windows(words.hash, k)`` of all rows."""
    a, b = int(words.first[row]), int(words.first[row + 1])
    if b - a >= k:
        return np.unique(wins[a:b - k + 1])
    if b > a:
        return windows(words.hash[a:b], b - a)
    return np.zeros(0, U64)
