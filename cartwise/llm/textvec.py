"""Whole-batch text arithmetic in numpy: word borders, word hashes and k-gram hashes of an Arrow column.

Nothing here loops over words. A block of rows is one byte array; words are
runs of bytes of a class, a word's hash is a polynomial over its bytes
(mixed), a k-gram's hash a polynomial over its words' hashes (mixed). Two
different words or k-grams share a 64-bit hash with probability 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from cartwise.llm.common import ship

ship(__name__)

BLOCK_BYTES = 1 << 20

_M64 = (1 << 64) - 1


def _class(pairs) -> np.ndarray:
    mask = np.ones(256, dtype=bool)
    for lo, hi in pairs:
        mask[lo:hi + 1] = False
    return mask


#: Bytes that belong to a word; UTF-8 lead and continuation bytes always do.
NOT_SPACE = _class([(0x20, 0x20), (0x09, 0x0D)])
ALNUM = _class([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply, shift, xor), vectorised."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_POWERS = {"byte": np.ones(1, dtype=np.uint64), "word": np.ones(1, dtype=np.uint64)}
_BASE = {"byte": 0xD6E8FEB86659FD93, "word": 0xA0761D6478BD642F}


def powers(kind: str, n: int) -> np.ndarray:
    have = _POWERS[kind]
    if len(have) < n:
        size = 1 << max(6, (n - 1).bit_length())
        have = np.ones(size, dtype=np.uint64)
        have[1:] = np.uint64(_BASE[kind])
        have = np.cumprod(have, dtype=np.uint64)
        _POWERS[kind] = have
    return have[:n]


@dataclass
class Words:
    """The words of a block of rows. ``first[r]:first[r + 1]`` are row r's words."""

    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    def row(self, r: int) -> slice:
        return slice(int(self.first[r]), int(self.first[r + 1]))


def column(values: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row borders of a string column; null counts as empty."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    values = values.cast(pa.large_string())
    if values.null_count:
        values = values.fill_null("")
    if len(values) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    borders = np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + len(values) + 1]
    data = values.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[borders[0]:borders[-1]], borders - borders[0]


def blocks(data: np.ndarray, borders: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about ``size`` bytes (a longer row is a block of its own): first row, bytes, borders."""
    r, n = 0, len(borders) - 1
    while r < n:
        e = max(r + 1, int(np.searchsorted(borders, borders[r] + size, side="right")) - 1)
        yield r, data[borders[r]:borders[e]], borders[r:e + 1] - borders[r]
        r = e


def words(data: np.ndarray, borders: np.ndarray, in_word: np.ndarray, cuts: np.ndarray | None = None) -> Words:
    """Words (runs of ``in_word`` bytes inside one row, cut before the bytes marked in ``cuts``) of a block and their hashes."""
    n = len(data)
    if n == 0:
        zero = np.zeros(0, np.int64)
        return Words(np.zeros(len(borders), np.int64), zero, zero, np.zeros(0, np.uint64))
    inside = in_word[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = borders[:-1][borders[:-1] < n]
    begins[heads] = inside[heads]
    if cuts is not None:
        begins |= cuts & inside
    ends = np.zeros(n + 1, dtype=bool)
    ends[1:n] = inside[:-1] & (~inside[1:] | begins[1:])
    ends[n] = inside[-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends)
    first = np.searchsorted(start, borders)
    if len(start) == 0:
        return Words(first, start, end, np.zeros(0, np.uint64))
    length = end - start
    at = np.arange(n, dtype=np.int32)
    anchor = np.zeros(n, dtype=np.int32)
    anchor[start] = start
    at -= np.maximum.accumulate(anchor)
    longest = int(length.max())
    value = _BYTE[data]
    value *= powers("byte", longest)[np.minimum(at, longest - 1)]
    value[~inside] = 0
    total = np.add.reduceat(value, start)
    return Words(first, start, end, mix(total + length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words that start at each word (the last k - 1 entries are left out)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, np.uint64((k * 0x9E3779B97F4A7C15) & _M64))
    for j, p in enumerate(powers("word", k)):
        out += hashes[j:j + n] * p
    return mix(out)
