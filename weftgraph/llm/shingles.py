"""Word and shingle hashes of whole Arrow columns, by numpy over the raw UTF-8 bytes.

A word is a run of ASCII letters (case-folded), digits, underscores or bytes of
other characters.  A shingle is ``SIZE`` words; a text with fewer words has one
shingle of all it has, a text without words none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SIZE = 5
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix64's finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables() -> tuple[np.ndarray, np.ndarray]:
    b = np.arange(256)
    fold = np.where((b >= 65) & (b <= 90), b + 32, b).astype(np.uint64)
    value = mix(fold * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x1234567))
    word = (b >= 128) | ((b >= 48) & (b <= 57)) | ((b >= 65) & (b <= 90)) | ((b >= 97) & (b <= 122)) | (b == 95)
    return value, word


_VALUE, _IS_WORD = _tables()
#: Bytes hashed at once, so that tables and temporary arrays stay small under any text.
PART = 1 << 19
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n; tables over ``PART`` are not kept."""
    if _powers and len(_powers[0]) >= n:
        return _powers[0][:n], _powers[1][:n]
    size = max(n, PART)
    inverse = pow(_BASE, -1, 1 << 64)
    made = [np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)))) for b in (_BASE, inverse)]
    if size == PART:
        _powers[:] = made
    return made[0][:n], made[1][:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and where each value begins (and the last ends)."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(column) else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where each text's words begin (one more entry at the end)."""
    data, offsets = utf8(column)
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = _IS_WORD[data]
    begin = inside[1:-1] & ~inside[:-2]
    end = inside[1:-1] & ~inside[2:]
    inner = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < n)]
    begin[inner] = inside[1:-1][inner]  # words end with their text
    end[inner - 1] = inside[1:-1][inner - 1]
    begin, end = np.flatnonzero(begin), np.flatnonzero(end) + 1
    hashes = np.empty(len(begin), np.uint64)
    at = 0
    while at < len(begin):  # words of one part of the bytes; a longer word is a part of its own
        first = int(begin[at])
        to = max(at + 1, int(np.searchsorted(end, first + PART, "right")))
        part = data[first : end[to - 1]]
        power, inverse = powers(len(part))
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_VALUE[part] * power, out=total[1:])
        low, high = begin[at:to] - first, end[at:to] - first
        hashes[at:to] = mix((total[high] - total[low]) * inverse[low] + (high - low - 1).astype(np.uint64))
        at = to
    return hashes, np.searchsorted(begin, offsets)


def shingle_hashes(column: pa.Array, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles in text order, and where each text's begin (one more entry at the end)."""
    words, at = word_hashes(column)
    counts = np.diff(at)
    kept = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    starts = np.concatenate(([0], np.cumsum(kept)))
    first = np.repeat(at[:-1], kept) + np.arange(starts[-1]) - np.repeat(starts[:-1], kept)
    length = np.minimum(np.repeat(counts, kept), size)
    out = length.astype(np.uint64)
    for i in range(size):
        there = i < length
        w = words[np.where(there, first + i, first)] if len(words) else np.zeros(0, np.uint64)
        out = np.where(there, mix(out * np.uint64(0xD6E8FEB86659FD93) + w), out)
    return out, starts
