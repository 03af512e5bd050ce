"""Words and word shingles of many texts at once, as flat numpy arrays.

Spark hands Arrow batches to a task; here the bytes of all texts of a batch are one array, and
words are found and hashed with whole-array operations. Work proceeds in slices, so the memory
needed besides the words themselves does not grow with a batch or with a single long text.

Word classes are sets of bytes. That is exact for UTF-8, since every byte of a character beyond
ASCII is 0x80 or higher.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 18

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

NOT_SPACE = np.ones(256, dtype=np.uint8)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = 0

ALPHANUMERIC = np.zeros(256, dtype=np.uint8)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and the offset of each row; null counts as empty."""
    if column.null_count:
        empty = "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b""
        column = pc.fill_null(column, empty)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32) if offsets else np.zeros(1, int)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_ranges(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes each; a longer row stands alone."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the finaliser of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    ones = np.full(SLICE + 1, _MULTIPLIER), np.full(SLICE + 1, _INVERSE)
    for each in ones:
        each[0] = 1
        np.multiply.accumulate(each, out=each)
    return ones


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray,
          fold: np.ndarray = LOWER) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end byte of every word, and the number of words of every row.

    ``kind`` gives each byte a class, 0 for none. A word is a longest run of bytes of one class
    within a row; ``fold`` is applied to its bytes before hashing.
    """
    if not len(data):
        return (np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 2,
                np.zeros(len(offsets) - 1, np.int64))
    classes = kind[data]
    inside = classes > 0
    change = classes[1:] != classes[:-1]
    first = inside.copy()
    first[1:] &= change
    last = inside.copy()
    last[:-1] &= change
    borders = offsets[1:-1]
    borders = borders[(borders > 0) & (borders < len(data))]
    first[borders] = inside[borders]
    last[borders - 1] = inside[borders - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = np.empty(len(starts), np.uint64)
    powers, inverses = _powers()
    done = 0
    while done < len(starts):
        begin = starts[done]
        until = max(int(np.searchsorted(ends, begin + SLICE, "right")), done + 1)
        if ends[until - 1] - begin > SLICE:  # one very long word
            hashes[done] = _long_word(data[begin:ends[done]], fold)
            done += 1
            continue
        part = fold[data[begin:ends[until - 1]]].astype(np.uint64)
        part += np.uint64(1)
        part *= powers[:len(part)]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part, out=sums[1:])
        at = starts[done:until] - begin
        hashes[done:until] = (sums[ends[done:until] - begin] - sums[at]) * inverses[at]
        done = until
    hashes = mix(hashes + (ends - starts).astype(np.uint64) * _STEP)
    counts = np.diff(np.searchsorted(starts, offsets))
    return hashes, starts, ends, counts


def _long_word(data: np.ndarray, fold: np.ndarray) -> np.uint64:
    powers, _ = _powers()
    total, shift = np.uint64(0), np.uint64(1)
    with np.errstate(over="ignore"):
        for begin in range(0, len(data), SLICE):
            part = fold[data[begin:begin + SLICE]].astype(np.uint64) + np.uint64(1)
            total = total + shift * (part * powers[:len(part)]).sum(dtype=np.uint64)
            shift = shift * powers[SLICE]
    return total


def shingles(hashes: np.ndarray, counts: np.ndarray, size: int,
             whole: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of ``size`` consecutive words at every position, the position, and rows' counts.

    With ``whole`` a row of fewer words has its whole sequence as its only shingle; otherwise
    it has none. Positions are indexes into ``hashes``.
    """
    ends = np.cumsum(counts)
    begins = ends - counts
    n = len(hashes)
    total = np.zeros(n, np.uint64)
    full = max(n - size + 1, 0)
    for j in range(size):
        total[:full] *= _MULTIPLIER
        total[:full] += hashes[j:j + full]
    own = np.maximum(counts - size + 1, 0)
    short = (counts > 0) & (counts < size) if whole else np.zeros(len(counts), bool)
    for row in np.flatnonzero(short):
        value = np.uint64(counts[row:row + 1]) * _STEP
        for h in hashes[begins[row]:ends[row]]:
            value = value * _MULTIPLIER + h
        total[begins[row]] = value[0]
    own = own + short
    positions = np.repeat(begins - (np.cumsum(own) - own), own) + np.arange(own.sum())
    return mix(total[positions]), positions, own
