"""Words of whole texts as numpy arrays, taken from the bytes of Arrow string columns.

A word is a maximal run of bytes other than space and \\t \\n \\v \\f \\r. Nothing is
looped over per word: word borders come from a byte table, and every word gets a
64-bit hash from prefix sums of ``table[byte] * base ** position`` (mod 2 ** 64),
which are shifted back to position zero by the inverse powers of the odd base.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 bits of the result."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


#: A random value per byte, so that words of few distinct bytes do not collide.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


@lru_cache(maxsize=1)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE and its inverse to the powers 0 .. n - 1."""
    with np.errstate(over="ignore"):
        up = np.full(n, BASE, np.uint64)
        down = np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


@dataclass
class Words:
    """Words of a run of rows: ``first`` has the index of each row's first word, and the total at its end."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    rows: slice

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        """Row of each word, from zero."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash per word, equal for equal words."""
        n = len(self.data)
        up, down = powers(max(CHUNK_BYTES, 1 << int(n).bit_length()))
        with np.errstate(over="ignore"):
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(BYTE_VALUES[self.data] * up[:n], out=sums[1:])
            return mix((sums[self.end] - sums[self.start]) * down[self.start])

    def text(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets


def split_words(column: pa.Array, lower: bool = False) -> Iterator[Words]:
    """Words of all rows, in runs of whole rows of about CHUNK_BYTES; a longer text is a run of its own."""
    data, offsets = bytes_of(column)
    n, at = len(offsets) - 1, 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1
        to = min(max(to, at + 1), n)
        part = data[offsets[at] : offsets[to]]
        yield _words(LOWER[part] if lower else part, offsets[at : to + 1] - offsets[at], slice(at, to))
        at = to


def _words(data: np.ndarray, offsets: np.ndarray, rows: slice) -> Words:
    n = len(data)
    inside = ~SPACE[data]
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    before = np.ones(n + 1, bool)
    before[1:] = ~inside
    before |= border
    after = np.ones(n + 1, bool)
    after[:n] = ~inside
    after |= border
    start = np.flatnonzero(inside & before[:n])
    end = np.flatnonzero(inside & after[1:]) + 1
    return Words(data, offsets, start, end, np.searchsorted(start, offsets), rows)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash per run of ``width`` consecutive hashes, by its first position; runs cross rows, so mask them."""
    n = max(0, len(hashes) - width + 1)
    with np.errstate(over="ignore"):
        total = np.full(n, width, np.uint64)
        for k in range(width):
            total += mix(hashes[k : k + n] + np.uint64((k + 1) * BASE & MASK))
            total *= np.uint64(BASE)
        return mix(total)


@contextmanager
def batches_of(spark, rows: int) -> Iterator[None]:
    """Arrow batches of so many rows while a table is written; the session's own setting comes back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def small_batches(spark, rows: int = 1000, size: int = 16 << 20) -> None:
    """Bound what one Arrow batch holds, as texts differ in length by orders of magnitude."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
