"""Whole texts of Arrow batches as byte arrays, and vectorised hashes over them.

Spark hands a task its rows in Arrow batches.  The helpers here cut a batch into
blocks of whole rows with a bounded number of bytes (a single longer text makes
a block of its own) and work on all bytes of a block at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 21
U = np.uint64
#: Odd multiplier of the rolling hash; its inverse modulo 2**64 undoes it.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

#: Fixed value: bytes between words (blank, tab to carriage return).
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and the offset of each row; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(batches: Iterator[pa.RecordBatch], text: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds at most ``limit`` bytes of ``text`` (or one row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
        total = np.cumsum(np.asarray(sizes, dtype=np.int64))
        at = 0
        while at < batch.num_rows:
            done = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, done + limit, "right")))
            yield batch.slice(at, end - at)
            at = end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


#: One odd random-looking number per byte value, from the bijection above.
BYTE_CODES = mix(np.arange(1, 257, dtype=U) * U(BASE)) | U(1)


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, U(base), U)
    out[0] = U(1)
    return np.multiply.accumulate(out)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    return _powers(base, 1 << max(16, int(n - 1).bit_length()))[:n]


class Rolling:
    """Hash of any byte range in constant time, by prefix sums modulo 2**64."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, U)
        np.cumsum(BYTE_CODES[data] * powers(BASE, n), out=self.sums[1:]) if n else None
        self.back = powers(INVERSE, n + 1)

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(U))

    def windows(self, size: int) -> np.ndarray:
        """Hash of every range of ``size`` bytes, by its start."""
        n = len(self.sums) - size
        if n <= 0:
            return np.zeros(0, U)
        return mix((self.sums[size:] - self.sums[:n]) * self.back[:n])


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the row it stands in; words never cross rows."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~SPACES[data]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    cuts = np.unique(offsets[1:-1])
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    within = cuts[inside[cuts].astype(bool) & inside[cuts + 1].astype(bool)]  # a row ends inside a run
    starts, ends = np.sort(np.concatenate([starts, within])), np.sort(np.concatenate([ends, within]))
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return Rolling(data).ranges(starts, ends)
