"""Byte and word arrays of text batches: the shared ground of the operators that hash text.

All functions work on one concatenated ``uint8`` buffer and the offsets of its texts, so that a
whole slice of a batch is handled by a few array operations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer text makes a slice of its own.
SLICE_BYTES = 1 << 19

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads each 64-bit value over all its bits (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base and of its inverse, modulo 2**64."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        made = []
        for base in (_BASE, _BASE_INVERSE):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            made.append(np.cumprod(p, dtype=np.uint64))
        if size > 4 * SLICE_BYTES:  # one huge text: not worth keeping
            return tuple(made)
        _powers = tuple(made)
    return _powers


class Hasher:
    """Hashes of any spans of one buffer, each in constant time."""

    def __init__(self, buf: np.ndarray):
        n = len(buf)
        up, self._down = powers(n + 1)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[buf] * up[:n], dtype=np.uint64, out=self._sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self._sums[ends] - self._sums[starts]) * self._down[starts]
        return mix(raw + (ends - starts).astype(np.uint64))

    def grams(self, size: int) -> np.ndarray:
        """Of each position at which a string of ``size`` bytes fits into the buffer."""
        n = len(self._sums) - size
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self._sums[size:] - self._sums[:n]) * self._down[:n])


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple]:
    """(first row, last row + 1, bytes, offsets) of runs of texts; a null counts as empty."""
    column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def runs(member: np.ndarray, buf: np.ndarray, offsets: np.ndarray) -> tuple:
    """Maximal runs of the bytes in ``member`` that stay within one text.

    Returns their starts, their ends, and for each text the index of its first run.
    """
    inside = member[buf]
    cut = np.zeros(len(buf) + 1, bool)
    cut[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:-1]
    finish = inside.copy()
    finish[:-1] &= ~inside[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finish) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_STEPS = mix(np.arange(101, 165, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)


def windows(hashes: np.ndarray, size: int, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive words, and for each text the index of its first window."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    n = len(hashes) - size + 1
    bounds = np.concatenate(([0], np.cumsum(counts)))
    if n <= 0:
        return np.zeros(0, np.uint64), bounds
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += hashes[k : k + n] * _STEPS[k]
    at = np.arange(bounds[-1]) + np.repeat(first[:-1] - bounds[:-1], counts)
    return mix(total[at]), bounds


def distinct_per_text(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each text in ascending order, and the new bounds."""
    if not len(values):
        return values, bounds
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((values, text))
    values, text = values[order], text[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    return values[new], np.concatenate(([0], np.cumsum(np.bincount(text[new], minlength=len(bounds) - 1))))
