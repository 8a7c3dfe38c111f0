"""Vectorised word scanning of Arrow text columns.

A word is a maximal run of ASCII letters, digits and non-ASCII bytes of the
lower-cased UTF-8 text; every other byte separates words.  Words are hashed to
64 bits straight from the Arrow buffer, a bounded slice of bytes at a time, so
neither a Python string per word nor an array per whole batch is ever built.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SLICE = 1 << 16
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit words with good diffusion."""
    x = np.array(x, dtype=np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(_SLICE + 65536, 1 << int(n).bit_length())
    if size not in _POWERS:
        if len(_POWERS) > 1:
            _POWERS.clear()
        up, down = np.full(size, _BASE, dtype=np.uint64), np.full(size, _INVERSE, dtype=np.uint64)
        up[0] = down[0] = 1
        _POWERS[size] = np.cumprod(up), np.cumprod(down)
    return _POWERS[size]


@dataclass
class Words:
    """The words of a batch in text order; starts are byte offsets into ``data``."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray  # index of each document's first word; one more entry at the end
    data: np.ndarray  # the lower-cased bytes of all documents
    offsets: np.ndarray  # of the documents in data


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]] if len(offsets) else data, offsets - (offsets[0] if len(offsets) else 0)


def words(column: pa.Array) -> Words:
    """All words of all texts of an Arrow string column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    data, offsets = text_buffer(pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), "")))
    hashes, starts, ends = [], [], []
    at, n = 0, len(data)
    while at < n:
        stop = min(n, at + _SLICE)
        if stop < n:  # stop where a word or a document ends
            while stop < n and _WORD[data[stop]]:
                ahead = data[stop : stop + 4096]
                rest = np.flatnonzero(~_WORD[ahead])
                stop += int(rest[0]) if len(rest) else len(ahead)
        part = data[at:stop]
        inside = _WORD[part]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        cuts = offsets[np.searchsorted(offsets, at, "right") : np.searchsorted(offsets, stop, "left")] - at
        cuts = np.unique(cuts[(cuts > 0) & (cuts < len(part))])
        cuts = cuts[inside[cuts] & inside[cuts - 1]]  # a word can't cross documents
        s = edge[inside[edge]]
        e = edge[~inside[edge]]
        if len(part) and inside[0]:
            s = np.r_[0, s]
        if len(part) and inside[-1]:
            e = np.r_[e, len(part)]
        if len(cuts):
            s, e = np.sort(np.r_[s, cuts]), np.sort(np.r_[e, cuts])
        up, down = _powers(len(part) + 1)
        total = np.zeros(len(part) + 1, dtype=np.uint64)
        weight = part.astype(np.uint64)
        weight += np.uint64(1)
        weight *= up[: len(part)]
        np.cumsum(weight, out=total[1:])
        hashes.append(mix((total[e] - total[s]) * down[s]))
        starts.append(s + at)
        ends.append(e + at)
        at = stop
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    s = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    e = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    first = np.searchsorted(s, offsets, "left")
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(h, s, e, doc, first, data, offsets)


def release() -> None:
    """Gives freed memory back to the system, so that idle Python workers hold little."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batch: pa.RecordBatch, text: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``most`` bytes of text each, whole rows only."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    at, total = 0, 0
    for i, size in enumerate(sizes):
        if i > at and total + size > most:
            yield batch.slice(at, i - at)
            at, total = i, 0
        total += int(size)
    if at < batch.num_rows:
        yield batch.slice(at, batch.num_rows - at)
    release()


def word_hash(word: str) -> int:
    """The hash that ``words`` gives one word; for tests and small tables."""
    found = words(pa.array([word])).hash
    return int(found[0]) if len(found) else 0
