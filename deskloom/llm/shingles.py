"""Hashed word shingles of whole texts, computed per Arrow batch with numpy."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

WORDS = 5
#: Bytes of text that are hashed at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 18

_draw = np.random.default_rng(20240229)
_PLACE = _draw.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_draw.integers(1, 2**62)) * 4 + 1
_INSIDE = np.ones(256, bool)
_INSIDE[[9, 10, 11, 12, 13, 32]] = False
#: A value per byte; none for blanks and the same for A-Z and a-z.
_BYTE = _draw.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_BYTE[~_INSIDE] = 0


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all their bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse modulo 2**64."""
    both = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        values = np.full(n, base, np.uint64)
        values[0] = 1
        both.append(np.multiply.accumulate(values))
    return both[0], both[1]


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    x = np.sort(x)
    keep = np.empty(len(x), bool)
    keep[:1] = True
    np.not_equal(x[1:], x[:-1], out=keep[1:])
    return x[keep]


def slices(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, row offsets) of pieces of about SLICE_BYTES; null is empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        last = max(row + 1, int(np.searchsorted(ends, ends[row] + SLICE_BYTES, side="right")) - 1)
        yield row, last, data[ends[row] : ends[last]], ends[row : last + 1] - ends[row]
        row = last


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word and the number of words before each row. Words are runs of
    bytes other than blanks and the control characters 9 to 13; A-Z count as a-z."""
    inside = _INSIDE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    rows = offsets[:-1][offsets[:-1] < len(data)]
    begins[rows] = inside[rows]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    powers, inverses = _powers(1 << max(18, (len(data) - 1).bit_length()))
    sums = np.add.reduceat(_BYTE[data] * powers[: len(data)], starts)
    return mix(sums * inverses[starts]), np.searchsorted(starts, offsets)


def shingle_sets(texts: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """Per row the sorted distinct hashes of its shingles of ``words`` words; a text with fewer
    words is one shingle, a text without words none."""
    for first, last, data, offsets in slices(texts):
        hashed, at = word_hashes(data, offsets)
        n = max(0, len(hashed) - words + 1)
        grams = np.zeros(n, np.uint64)
        for k in range(words):
            grams += hashed[k : k + n] * _PLACE[k]
        grams = mix(grams)
        for row in range(last - first):
            start, end = at[row], at[row + 1]
            if end - start >= words:
                yield distinct(grams[start : end - words + 1])
            elif end > start:
                short = hashed[start:end]
                yield mix((short * _PLACE[: len(short)]).sum(dtype=np.uint64, keepdims=True) + _PLACE[words + len(short)])
            else:
                yield np.zeros(0, np.uint64)


def signature(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that tell sets apart."""
    one = shingles.sum(dtype=np.uint64)
    two = mix(shingles ^ _PLACE[0]).sum(dtype=np.uint64)
    return int(one.view(np.int64)), int(two.view(np.int64))
