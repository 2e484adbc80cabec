"""Words of whole texts as arrays.

A text column of an Arrow batch is cut into pieces of whole rows; bytes are folded,
split and hashed for all rows of a piece at once, so that no Python loop runs over
words. Positions are byte positions in the UTF-8 text, and folding keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once; a longer text is a piece of its own.
PIECE_BYTES = 1 << 20


def _table(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Separators of words ``[^\x20\x09-\x0D]+``.
SPACE = _table((0x20, 0x20), (0x09, 0x0D))
#: Separators of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (after lower-casing).
NOT_ALNUM = _table((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


class Piece(NamedTuple):
    """Rows ``first`` to ``last`` (exclusive) of a batch: their bytes and row borders."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """Borders of the words and, per row, the number of its first word (one more at the end)."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def pieces(column: pa.Array, size: int = PIECE_BYTES) -> Iterator[Piece]:
    """Cuts a text column into pieces of whole rows; null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, borders, data = column.buffers()
    offsets = np.frombuffer(borders, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first, rows = 0, len(column)
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), rows)
        low, high = offsets[first], offsets[last]
        yield Piece(first, last, data[low:high], offsets[first : last + 1] - low)
        first = last


def split(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE) -> Words:
    """Words of each row."""
    if not len(data):
        none = np.empty(0, np.int64)
        return Words(none, none, np.zeros(len(offsets), np.int64))
    gap = separators[data]
    start, end = ~gap, ~gap
    borders = offsets[(offsets > 0) & (offsets < len(data))]
    inner = gap[:-1].copy()
    inner[borders - 1] = True
    start[1:] &= inner
    inner = gap[1:].copy()
    inner[borders - 1] = True
    end[:-1] &= inner
    start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
    return Words(start, end, np.searchsorted(start, offsets))


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit numbers (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, PIECE_BYTES + 1)
        both = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            both.append(np.multiply.accumulate(row))
        _powers = (both[0], both[1])
    return _powers


def hash_words(data: np.ndarray, words: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same wherever the word stands."""
    if not len(words.start):
        return np.empty(0, np.uint64)
    up, down = _powers_to(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTES[data] * up[: len(data)], out=sums[1:])
    value = (sums[words.end] - sums[words.start]) * down[words.start]
    length = (words.end - words.start).astype(np.uint64)
    return mix(value + length * np.uint64(0xA0761D6478BD642F))


_PLACES = mix(np.arange(101, 165, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB)) | np.uint64(1)


def windows(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``n`` words of each row, and the row borders among them.

    A row with fewer words, but not none, has one run: all its words.
    """
    counts = np.diff(first)
    total = len(hashes)
    end = np.repeat(first[1:], counts)
    begin = np.repeat(first[:-1], counts)
    at = np.arange(total)
    padded = np.concatenate([hashes, np.zeros(n, np.uint64)])
    value = np.zeros(total, np.uint64)
    for j in range(n):
        value += np.where(at + j < end, padded[j : j + total] * _PLACES[j], np.uint64(0))
    value += np.minimum(end - at, n).astype(np.uint64) * np.uint64(0x8EBC6AF09C88C6E3)
    whole = (at + n <= end) | ((at == begin) & (end - begin < n))
    sizes = np.where(counts >= n, counts - n + 1, counts > 0)
    return mix(value[whole]), np.concatenate([[0], np.cumsum(sizes)])


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return np.ascontiguousarray(x).view(np.int64)
