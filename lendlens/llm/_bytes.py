"""Vectorised work on the UTF-8 bytes of an Arrow text column.

Helpers for the Python side of the text operators: they see one Arrow batch
at a time, cut it into blocks of bounded bytes and find words and their
64-bit hashes for the whole block at once, without a Python loop per word.
Every text is looked at from end to end; null counts as the empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20  # text bytes worked on at once (one longer text is a block of its own)

_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every output bit depends on all input bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def run_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit hash of the codes (at most 511) in each of the sorted, disjoint
    runs; another ``salt`` gives an independent one.

    A run's hash adds up a scrambled number for each pair of code and place in
    the run. There is no polynomial in it, so no family of words is known to
    collide; what must not rest on a hash at all compares bytes as well.
    """
    n = len(codes)
    if not len(starts):
        return np.empty(0, np.uint64)
    place = np.arange(n, dtype=np.uint64)
    place[starts[0]:] -= np.repeat(starts, np.diff(np.append(starts, n))).astype(np.uint64)
    place <<= np.uint64(9)
    place += codes.astype(np.uint64)
    place ^= np.uint64(salt)
    place *= _P
    place ^= place >> np.uint64(29)
    place *= _Q
    place ^= place >> np.uint64(32)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(place, out=sums[1:])
    return mix(sums[ends] - sums[starts])


def blocks(array: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES
           ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of rows of at most ``limit`` bytes.

    Yields (first row, end row, bytes, offsets): row ``first + i`` holds
    ``bytes[offsets[i]:offsets[i + 1]]``. Nulls are empty.
    """
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null("")
    array = array.cast(pa.large_binary())
    n = len(array)
    if not n:
        return
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset:array.offset + n + 1]
    data = (np.frombuffer(array.buffers()[2], np.uint8) if array.buffers()[2] is not None
            else np.empty(0, np.uint8))
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end
    pa.default_memory_pool().release_unused()


def table(separators: bytes, lower: bool) -> np.ndarray:
    """Byte table for ``words``: 0 for separators, else the byte plus one
    (A-Z as a-z when ``lower``, before separators are looked at)."""
    out = np.arange(1, 257, dtype=np.uint16)
    out[list(separators)] = 0
    if lower:
        out[65:91] = out[97:123]
    return out


# Separators of the two word definitions used by the operators (fixed values).
SPACE = bytes([0x20, *range(0x09, 0x0E)])
NON_ALNUM = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


def words(data: np.ndarray, offsets: np.ndarray, codes: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a block: (starts, ends, hashes, first): byte positions, a 64-bit
    hash of each word's bytes, and for every text the index of its first word
    (one more entry than texts). Words never span two texts."""
    n = len(data)
    c = codes[data]
    inside = c > 0
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    stop = inside.copy()  # last byte of a word
    stop[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    begin[cuts] = inside[cuts]
    stop[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    return starts, ends, run_hashes(c, starts, ends), np.searchsorted(starts, offsets)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Order-dependent hash of every ``n`` consecutive word hashes (by
    position of the first; empty when there are fewer words)."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.empty(0, np.uint64)
    out, width, level, power = None, 0, hashes, 1
    while True:
        if n & power:
            if out is None:
                out = level[:size + n - power].copy()
            else:
                m = len(out) - power
                out = mix(out[power:power + m] * _Q + level[:m])
            width += power
        power <<= 1
        if power > n:
            return mix(out[:size])
        half = power >> 1
        level = mix(level[:-half] * _Q + level[half:])


def within(first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of n-grams that stay inside one text: (positions, text)."""
    counts = np.maximum(np.diff(first) - (n - 1), 0)
    text = np.repeat(np.arange(len(counts)), counts)
    base = np.cumsum(counts) - counts
    return np.arange(counts.sum()) - np.repeat(base - first[:-1], counts), text
