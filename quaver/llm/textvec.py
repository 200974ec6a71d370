"""Vectorised views of Arrow text columns: bounded slices, word bounds and word hashes.

Everything works on the UTF-8 bytes of a slice at once; no per-word Python objects.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of [\x20\x09-\x0D], the white space of every word rule here.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

SLICE_BYTES = 2 << 20

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i modulo 2**64 for i up to n."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 65)
        inverse = np.uint64(pow(int(_BASE), -1, 2**64))
        tables = []
        for base in (_BASE, inverse):
            t = np.full(size, base, np.uint64)
            t[0] = 1
            np.multiply.accumulate(t, out=t)
            tables.append(t)
        _powers[:] = tables
    return _powers[0], _powers[1]


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges of at most `limit` text bytes each; a longer text is a slice of its own, whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        total = np.concatenate(([0], np.cumsum(size)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(total, total[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if column.null_count:
        column = pc.fill_null(column, "")
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]] if buffers[2] is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64 (splitmix64's public constants)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


#: Places of a word whose random numbers are kept; further ones are made each time.
PLACES = 256


def _cell(cell: np.ndarray, kind: int) -> np.ndarray:
    return mix(mix(cell.astype(np.uint64) + np.uint64((kind + 1) * 0x3C79AC492BA7B653 % 2**64)) ^ np.uint64(0x1C69B3F74AC4AE35))


@functools.lru_cache
def _cells(kind: int) -> np.ndarray:
    return _cell(np.arange(PLACES << 8), kind)


class Words:
    """Words of all texts of a slice: start, end (byte bounds), doc (row) and per-row counts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, stop: np.ndarray = SPACE) -> None:
        self.data, self.offsets = data, offsets
        n, rows = len(data), len(offsets) - 1
        word = ~stop[data]
        begins = np.zeros(n + 1, bool)
        begins[offsets] = True
        first = word.copy()
        if n:
            first[1:] &= ~word[:-1] | begins[1:n]
        last = word.copy()
        if n:
            last[:-1] &= ~word[1:] | begins[1:n]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        bounds = np.searchsorted(self.start, offsets)
        self.first = bounds[:-1]
        self.count = np.diff(bounds)
        self.doc = np.repeat(np.arange(rows), self.count)

    def hashes(self, kind: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes, equal for equal words everywhere: a sum of one random number for every
        (place, byte) of the word. Kinds are independent hashes. Two words meet by chance only, whatever they look like."""
        n = len(self.data)
        begin = np.zeros(n, np.int64)
        begin[self.start] = self.start
        place = np.arange(n) - np.maximum.accumulate(begin) if n else begin
        cell = place << 8 | self.data
        near = place < PLACES
        value = _cells(kind)[np.where(near, cell, 0)]
        if not near.all():
            value[~near] = _cell(cell[~near], kind)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(value, out=sums[1:])
        return mix(sums[self.end] - sums[self.start] + (self.end - self.start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def windows(self, width: int) -> np.ndarray:
        """Indices of words that begin a window of `width` words of one row."""
        left = self.first + self.count
        return np.flatnonzero(np.arange(len(self.start)) + width <= np.repeat(left, self.count))


def rolled(h: np.ndarray, width: int, base: int = 0xA24BAED4963EE407) -> np.ndarray:
    """Hash of each run of `width` consecutive word hashes (also across rows: index it by Words.windows)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    factor = 1
    for j in range(width):
        out += h[j : j + n] * np.uint64(factor)
        factor = factor * base % 2**64
    return mix(out)
