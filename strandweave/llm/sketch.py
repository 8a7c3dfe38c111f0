"""Fixed-size counting sketches of all rows, merged without the driver seeing more than one of them.

A sketch has a fixed number of cells whatever the input holds, so its size is a
constant: that is the bound under which it is broadcast.  Every task counts into
its own array and ships it in compressed blocks; blocks are summed by partition.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .scan import mix

BLOCK = 1 << 16
_SCHEMA = pa.schema([("block", pa.int32()), ("counts", pa.binary())])


def _rows(counts: dict[int, np.ndarray]) -> pa.RecordBatch:
    keys = [k for k in sorted(counts) if counts[k].any()]
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array([zlib.compress(counts[k].tobytes(), 1) for k in keys], pa.binary())], schema=_SCHEMA)


def add(total: np.ndarray, hashes: np.ndarray) -> None:
    """Counts hashes into a task's own array."""
    total += np.bincount((hashes & np.uint64(len(total) - 1)).astype(np.int64), minlength=len(total)).astype(np.uint32)


def blocks(total: np.ndarray) -> pa.RecordBatch:
    """A task's array as rows of compressed blocks."""
    return _rows(dict(enumerate(total.reshape(-1, BLOCK))))


def merged(rows: DataFrame, cells: int) -> np.ndarray:
    """The sum of the arrays of all tasks, from their rows (block, counts)."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(zlib.decompress(packed), np.uint32)
                total[block] = total[block] + part if block in total else part
        if total:
            yield _rows(total)

    n = cells // BLOCK
    out = np.zeros((n, BLOCK), np.uint32)
    for row in rows.repartition(min(32, n), "block").mapInArrow(merge, "block int, counts binary").collect():  # one row per block at most: the size of one sketch
        out[row["block"]] = np.frombuffer(zlib.decompress(row["counts"]), np.uint32)
    return out.ravel()


def sketch(df: DataFrame, cells: int, hashes: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """Counts of the hashes of all rows, by their lowest bits (``cells`` is a power of two, at least BLOCK)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.uint32)
        for batch in batches:
            add(total, hashes(batch))
        if total.any():
            yield blocks(total)

    return merged(df.mapInArrow(count, "block int, counts binary"), cells)


class Bloom:
    """A set of 64-bit values that may hold a few more: two bits a value, in at most ``MOST`` bits (16 MB)."""

    MOST = 1 << 27

    def __init__(self, packed: np.ndarray):
        self.packed = packed

    def holds(self, values: np.ndarray) -> np.ndarray:
        h = mix(values.astype(np.uint64))
        out = np.ones(len(h), bool)
        for part in (h, h >> np.uint64(32)):
            slot = (part & np.uint64(len(self.packed) * 8 - 1)).astype(np.int64)
            out &= (self.packed[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
        return out


def bloom(values: DataFrame, n: int) -> Bloom:
    """The filter of a long column of ``n`` rows: about 16 bits a row up to ``Bloom.MOST``; tasks send compressed blocks of their bits."""
    size = min(Bloom.MOST, max(BLOCK * 8, 1 << (16 * max(1, n) - 1).bit_length())) // 8

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.uint8)
        for batch in batches:
            h = mix(batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint64))
            for part in (h, h >> np.uint64(32)):
                slot = (part & np.uint64(size * 8 - 1)).astype(np.int64)
                np.bitwise_or.at(total, slot >> 3, np.uint8(1) << (slot & 7).astype(np.uint8))
        yield _packed(total.reshape(-1, BLOCK))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(zlib.decompress(packed), np.uint8)
                total[block] = total[block] | part if block in total else part
        keys = sorted(total)
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array([zlib.compress(total[k].tobytes(), 1) for k in keys], pa.binary())], schema=_SCHEMA)

    out = np.zeros((size // BLOCK, BLOCK), np.uint8)
    rows = values.mapInArrow(mark, "block int, counts binary").repartition(min(32, len(out)), "block")
    for row in rows.mapInArrow(merge, "block int, counts binary").collect():  # a row a block: 16 MB at most
        out[row["block"]] = np.frombuffer(zlib.decompress(row["counts"]), np.uint8)
    return Bloom(out.ravel())


def _packed(parts: np.ndarray) -> pa.RecordBatch:
    keys = [k for k in range(len(parts)) if parts[k].any()]
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array([zlib.compress(parts[k].tobytes(), 1) for k in keys], pa.binary())], schema=_SCHEMA)


def levels(counts: np.ndarray) -> np.ndarray:
    """Counts on a scale of 256 logarithmic levels (one byte a cell)."""
    return np.minimum(255, np.round(8 * np.log2(1 + counts.astype(np.float64)))).astype(np.uint8)
