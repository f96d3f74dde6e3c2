"""Words and word shingles of many texts at once, as arrays over the UTF-8 bytes of an Arrow column.

A word is a maximal run of bytes other than space, tab, line feed, vertical tab, form feed and carriage
return; A-Z count as a-z. Words and shingles are named by 64-bit hashes that depend on their bytes only.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from lectern.operators.sizing import small_batches as small_batches

#: Bytes of text that are worked on at once; a longer text is a piece of its own.
PIECE_BYTES = 1 << 20
SHINGLE = 5

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _inverse(odd: int) -> int:
    x = odd
    for _ in range(6):
        x = x * (2 - odd * x) & 0xFFFFFFFFFFFFFFFF
    return x


def _scramble(x: np.ndarray) -> np.ndarray:
    """Spread every bit of each number over all its bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * _MIX
    x = x ^ (x >> np.uint64(29))
    x = x * _MIX
    return x ^ (x >> np.uint64(32))


_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
#: Everything in ASCII but letters and digits.
PUNCTUATION = np.array([not (chr(b).isalnum() or b >= 0x80) for b in range(256)])
_EXACT = _scramble(np.arange(1, 257, dtype=np.uint64) * _BASE) | np.uint64(1)
_LOWER = _EXACT.copy()
_LOWER[ord("A") : ord("Z") + 1] = _EXACT[ord("a") : ord("z") + 1]
_FACTORS = _scramble(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)
_powers = {"up": np.ones(0, np.uint64), "down": np.ones(0, np.uint64)}


def _power(name: str, n: int) -> np.ndarray:
    if len(_powers[name]) < n:
        base = _BASE if name == "up" else np.uint64(_inverse(int(_BASE)))
        table = np.full(max(n, PIECE_BYTES + 8), base, np.uint64)
        table[0] = 1
        _powers[name] = np.multiply.accumulate(table)
    return _powers[name][:n]


def give_back() -> None:
    """A task is over: memory that it freed leaves the worker, which may wait or serve other work next."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # only the C library of GNU keeps so much
        ctypes.CDLL(None).malloc_trim(0)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each row starts (one more entry than rows). Null is empty."""
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch`` in order, cut so that each part holds about ``limit`` bytes of text or one row."""
    _, offsets = utf8(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def find_words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = _SEPARATOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each row (and the end) its first word."""
    inside = ~separator[data]
    opens = np.ones(len(data) + 1, bool)  # a row begins here, or the byte before is a separator
    opens[1:] = ~inside
    opens[offsets] = True
    starts = np.flatnonzero(inside & opens[:-1])
    closes = np.ones(len(data) + 1, bool)
    closes[:-1] = ~inside
    closes[offsets] = True
    ends = np.flatnonzero(inside & closes[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of the bytes of each slice; slices are in order and do not overlap."""
    out = np.zeros(len(starts), np.uint64)
    table, at = _LOWER if lower else _EXACT, 0
    while at < len(starts):
        low = starts[at]
        to = max(int(np.searchsorted(ends, low + PIECE_BYTES, side="right")), at + 1)
        high = ends[to - 1]
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(table[data[low:high]] * _power("up", high - low), out=sums[1:])
        a, b = starts[at:to] - low, ends[at:to] - low
        out[at:to] = (sums[b] - sums[a]) * _power("down", high - low + 1)[a] + (b - a).astype(np.uint64)
        at = to
    return _scramble(out)


def hash_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, A-Z as a-z, and each row's first word."""
    starts, ends, rows = find_words(data, offsets)
    return hash_slices(data, starts, ends, lower=True), rows


def combine(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n words in a row; entry i is for the words i to i + n - 1."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    total = words[: len(words) - n + 1] * _FACTORS[0]
    for j in range(1, n):
        total = total + words[j : len(words) - n + 1 + j] * _FACTORS[j]
    return _scramble(total + np.uint64(n))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int = SHINGLE) -> list[np.ndarray]:
    """For each row the sorted distinct hashes of its n-word shingles.

    A row of fewer than n words, but at least one, has its whole sequence as one shingle; a row without
    words has none.
    """
    words, rows = hash_words(data, offsets)
    grams = combine(words, n)
    sets = []
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True):
        if b - a >= n:
            sets.append(np.unique(grams[a : b - n + 1]))
        elif b > a:
            sets.append(combine(words[a:b], b - a))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
