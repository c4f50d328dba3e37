"""Texts of Arrow batches as byte arrays, and hashes of their words and windows, by numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_PLACES = np.arange(1, 65, dtype=np.uint64) * _ODD
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch with at most ``limit`` bytes, but one row at least, in a binary column.

    Gives the rows, their bytes one after the other, and the offsets of each row; null is empty.
    """
    start, sizes = 0, np.diff(_offsets(batch.column(column)))
    ends = np.cumsum(sizes)
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        part = batch.slice(start, stop - start)
        array = part.column(column)
        offsets = _offsets(array)
        data = array.buffers()[2]
        whole = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
        yield part, whole[offsets[0] : offsets[-1]], offsets - offsets[0]
        start = stop


def _offsets(array: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_binary(array.type) else np.int32
    if not len(array):
        return np.zeros(1, dtype=np.int64)
    found = np.frombuffer(array.buffers()[1], dtype=kind)
    return found[array.offset : array.offset + len(array) + 1].astype(np.int64)


#: Powers of an odd number modulo 2**64 and their inverses, as far as any text needed them.
_BASE = 0xD6E8FEB86659FD93
_POWERS: list[np.ndarray] = []
#: Bytes whose terms are added up at once: they stay in the processor's cache.
_TERMS = 1 << 15


def _powers(size: int) -> list[np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < size:
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            table = np.full(max(size, 1 << 16), base, dtype=np.uint64)
            table[0] = 1
            tables.append(np.multiply.accumulate(table, out=table))
        _POWERS[:] = tables
    return _POWERS


class Rolling:
    """Hashes of any substring of some bytes, from prefix sums of a polynomial modulo 2**64."""

    def __init__(self, data: np.ndarray):
        power, self._inverse = _powers(len(data) + 1)
        sums = self._sums = np.zeros(len(data) + 1, dtype=np.uint64)
        for a in range(0, len(data), _TERMS):
            terms = data[a : a + _TERMS].astype(np.uint64)
            terms += np.uint64(1)
            terms *= power[a : a + len(terms)]
            terms[:1] += sums[a : a + 1]
            np.cumsum(terms, out=sums[a + 1 : a + 1 + len(terms)])

    def substrings(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        value = (self._sums[ends] - self._sums[starts]) * self._inverse[starts]
        return mixed(value ^ ((ends - starts).astype(np.uint64) * _ODD))

    def windows(self, width: int, first: int = 0, stop: int | None = None) -> np.ndarray:
        """Of the window at each place where one fits, from ``first`` to before ``stop``."""
        n = len(self._sums) - width
        stop = n if stop is None else min(stop, n)
        if stop <= first:
            return np.zeros(0, dtype=np.uint64)
        return mixed((self._sums[first + width : stop + width] - self._sums[first:stop]) * self._inverse[first:stop])

    def grid(self, columns: int, width: int) -> np.ndarray:
        """Of the windows that fit into each row, if the bytes are rows of ``columns``."""
        starts, ends, inverse = (x.reshape(-1, columns) for x in (self._sums[:-1], self._sums[1:], self._inverse[: len(self._sums) - 1]))
        n = columns - width + 1
        return mixed((ends[:, width - 1 :] - starts[:, :n]) * inverse[:, :n])


def mixed(value: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    value = value ^ (value >> np.uint64(32))
    value *= np.uint64(0xD6E8FEB86659FD93)
    value ^= value >> np.uint64(32)
    value *= np.uint64(0xD6E8FEB86659FD93)
    value ^= value >> np.uint64(32)
    return value


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return _LOWER[data]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, which ASCII white space separates, and the row of each."""
    inside = ~_SPACE[data]
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = inside
    before[offsets] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(data) + 1, dtype=bool)
    after[:-1] = inside
    after[offsets] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word in lower case, and the number of words of each row."""
    low = lowered(data)
    starts, ends, rows = word_bounds(low, offsets)
    counts = np.bincount(rows, minlength=len(offsets) - 1)
    return Rolling(low).substrings(starts, ends), counts


def shingle_hashes(words: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct runs of ``width`` words of each row, ascending, and their numbers.

    A row with fewer words has its whole sequence as the only one; a row without words has none.
    """
    first = np.cumsum(counts) - counts
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    rows = np.repeat(np.arange(len(counts)), n)
    at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    value = np.zeros(len(at), dtype=np.uint64)
    for i in range(width):
        there = i < counts[rows]
        word = words[np.minimum(at + i, max(len(words) - 1, 0))] if len(words) else value
        step = mixed(value ^ (word + _PLACES[i]))
        value = np.where(there, step, value)
    order = np.lexsort((value, rows))
    value, rows = value[order], rows[order]
    fresh = np.ones(len(value), dtype=bool)
    fresh[1:] = (value[1:] != value[:-1]) | (rows[1:] != rows[:-1])
    return value[fresh], np.bincount(rows[fresh], minlength=len(counts))
