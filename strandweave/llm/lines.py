"""Line dedup by an exact set-similarity join.

A line is its set of words; equal sets are one class.  Two classes are linked if
their Jaccard similarity is ``threshold`` or more.  A line is removed if an earlier
line (order: doc_id, then line number) is of its class or of a linked one; lines of
fewer than ``least`` different words stay (the registered query and the pipeline use
1: only lines without a word stay).

1. All words are counted into a fixed-size sketch, which gives one total order of
   words, rarest first (ties by hash).  Any total order keeps the join exact;
   rarity keeps its buckets small.
2. Each class sends a row (word, class, size, position, bitmap) for every word of
   its prefix (n - ceil(t n) + 1 words), once a task, in columnar blocks; classes
   too short to reach the threshold with any other set (up to three words at 0.8)
   send none.  Words that the sketch counts more than ``HOT`` times are dealt to a
   triangle of cells, so no word's rows have to fit one task.
3. In a word's bucket, ordered by size, pairs that pass the length, positional and
   bitmap filters, none of which drops a match, are joined to groups.  Only a
   spanning forest leaves the task, never the pairs; so groups hold every link.
4. Each class of a group is sent once, with its whole set, to its group; groups of
   more than ``WIDE`` classes are dealt to a triangle of cells of that width.  There
   every pair is decided on whole sets, and a row a class leaves: its number of
   links, its earliest linked line, and a root of its linked classes.
5. Removals are joined back to the documents that have any.

Words are known by a 64-bit hash, here and in the final check; equal sets by a
64-bit hash.  Null text counts as empty; a null doc_id counts as the lowest; ids
may be of any type that sorts.  Rows with equal doc_id are ordered by line number
only, so identical rows don't remove each other's lines.  Extra columns stay,
whatever their names; ``n_lines``, ``n_removed``, ``n_near`` and ``first_doc`` (and
``class_id`` and ``n_links``) replace columns of those names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWEST, drop_tables, fresh, materialise, numbered, renamed_ids, tables_made
from .decontaminate import expand
from .groups import components, unite, whole_groups
from .scan import mix, release, slices, words
from .sketch import add, blocks, bloom, levels, merged

CELLS = 1 << 20
HOT = 1 << 16
WIDE = 2048
_SALT = np.uint64(0x5851F42D4C957F2D)
_BIN = np.uint64(0xA0761D6478BD642F)
_WIDTHS = (1, 2, 4, 8)  # 64-bit lanes of bitmaps
_LANES = np.select([np.arange(402) <= 56, np.arange(402) <= 160, np.arange(402) <= 400], _WIDTHS[:3], _WIDTHS[3])


class LineSets:
    """The word sets of all lines with at least ``least`` different words, of one slice of documents."""

    def __init__(self, column: pa.Array, least: int):
        w = words(column)
        breaks = np.flatnonzero(w.data == 10)
        number = np.searchsorted(breaks, w.start) + w.doc  # line feeds before the word, and documents
        order = _by_group(number, w.hash, 44)
        owner, token = number[order], w.hash[order]
        new = np.r_[True, (owner[1:] != owner[:-1]) | (token[1:] != token[:-1])] if len(token) else np.zeros(0, bool)
        owner, token = owner[new], token[new]
        start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, np.int64)
        n = np.diff(np.r_[start, len(owner)])
        big = n >= least
        self.token = token[np.repeat(big, n)]
        self.n = n[big]
        self.first = np.r_[0, np.cumsum(self.n)].astype(np.int64)
        ids = owner[start[big]]
        # a line's document: the one whose numbers include it
        base = np.searchsorted(breaks, w.offsets[:-1]) + np.arange(len(w.offsets) - 1)
        self.doc = np.searchsorted(base, ids, "right") - 1
        self.line = ids - base[self.doc] if len(ids) else ids
        sums = np.add.reduceat(mix(self.token ^ _SALT), self.first[:-1]) if len(self.n) else np.zeros(0, np.uint64)
        self.cls = mix(sums).astype(np.int64)

    def keep(self, rows: np.ndarray) -> None:
        entry, _ = expand(self.first, rows)
        self.token = self.token[entry]
        self.n, self.doc, self.line, self.cls = self.n[rows], self.doc[rows], self.line[rows], self.cls[rows]
        self.first = np.r_[0, np.cumsum(self.n)].astype(np.int64)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.n)), self.n)


def _by_group(group: np.ndarray, value: np.ndarray, shift: int, between: np.ndarray | None = None) -> np.ndarray:
    """The order by (group, between, value): one 64-bit sort where the top bits of the values decide."""
    if not len(group):
        return np.zeros(0, np.int64)
    if int(group.max()) < 1 << (64 - shift):
        key = group.astype(np.uint64) << np.uint64(shift)
        if between is None:
            key |= value >> np.uint64(64 - shift)
        else:
            key |= (between.astype(np.uint64) << np.uint64(shift - 8)) | (value >> np.uint64(72 - shift))
        order = np.argsort(key)
        key, v = key[order], value[order]
        if not ((key[1:] == key[:-1]) & (v[1:] != v[:-1])).any():
            return order
    return np.lexsort((value, group) if between is None else (value, between, group))


class Seen:
    """Which classes a task has met before: a cache of fixed size that may forget, but never errs."""

    def __init__(self, size: int = 1 << 20):
        self.held = np.zeros(size, np.int64)
        self.held[0] = 1  # class 0 belongs here and is new, too

    def new(self, cls: np.ndarray) -> np.ndarray:
        """Rows whose class is not remembered, one a class."""
        rows = np.unique(cls, return_index=True)[1]
        slot = (mix(cls[rows].astype(np.uint64)) & np.uint64(len(self.held) - 1)).astype(np.int64)
        fresh_ = self.held[slot] != cls[rows]
        self.held[slot] = cls[rows]
        return np.sort(rows[fresh_])


SCAN = "kind int, cls bigint, doc bigint, row bigint, line int, block int, counts binary"


def _scan(batches, least: int):
    """Kind 0: the class of each line.  Kind 1: this task's counts of the words of its classes."""
    schema = pa.schema([("kind", pa.int32()), ("cls", pa.int64()), ("doc", pa.int64()), ("row", pa.int64()), ("line", pa.int32()), ("block", pa.int32()), ("counts", pa.binary())])
    total, seen = np.zeros(CELLS, np.uint32), Seen()
    for batch in batches:
        for part in slices(batch, "text"):
            ids, rows, sets = part.column(0).to_numpy(), part.column(2).to_numpy(), LineSets(part.column(1), least)
            n = len(sets.n)
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int32)), pa.array(sets.cls), pa.array(ids[sets.doc]), pa.array(rows[sets.doc]), pa.array(sets.line, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], schema=schema)
            sets.keep(seen.new(sets.cls))
            add(total, mix(sets.token))
    if total.any():
        rows = blocks(total)
        n = rows.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.ones(n, np.int32)), *[pa.nulls(n, pa.int64())] * 3, pa.nulls(n, pa.int32()), rows.column(0), rows.column(1)], schema=schema)


def needed(n: np.ndarray, m: np.ndarray, threshold: float) -> np.ndarray:
    """The least overlap of sets of n and m words that reaches the threshold."""
    return np.ceil(threshold / (1 + threshold) * (n + m) - 1e-9).astype(np.int64)


def lanes_of(n: np.ndarray) -> np.ndarray:
    """64-bit lanes of the bitmap of a set of n words.

    Unrelated sets of 13 to 900 words pass with a chance of less than one in 100,000.
    More would join most lines of a large input to one group, whose cells cost the
    square of its size.
    """
    return _LANES[np.minimum(n, len(_LANES) - 1)]


def bitmaps(sets: LineSets) -> tuple[np.ndarray, np.ndarray]:
    """The parity of the words at each bit, and where each set's lanes start; a map folded by exclusive or is the narrower one."""
    lanes = lanes_of(sets.n)
    at = np.r_[0, np.cumsum(lanes)].astype(np.int64)
    bit = (mix(sets.token + np.uint64(77)) & np.repeat((64 * lanes - 1).astype(np.uint64), sets.n)).astype(np.int64)
    odd = np.bincount(bit + np.repeat(64 * at[:-1], sets.n), minlength=64 * at[-1]).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view(np.uint64), at


BLOCKS = "bin int, n_rows int, key binary, cls binary, n binary, pos binary, bits binary"
_BLOCKS = pa.schema([("bin", pa.int32()), ("n_rows", pa.int32()), *[(c, pa.binary()) for c in ("key", "cls", "n", "pos", "bits")]])


def _prefix_rows(sets: LineSets, rank: np.ndarray, threshold: float):
    """(word hash, class, n, position, hotness) of the prefixes, and the rows' classes by number."""
    level = rank[(mix(sets.token) & np.uint64(CELLS - 1)).astype(np.int64)]
    owner = sets.owner()
    order = _by_group(owner, sets.token, 40, level)
    pos = np.arange(len(owner)) - np.repeat(sets.first[:-1], sets.n)
    length = sets.n - np.ceil(threshold * sets.n - 1e-9).astype(np.int64) + 1
    chosen = pos < np.repeat(length, sets.n)
    return mix(sets.token[order[chosen]] ^ _BIN), owner[chosen], pos[chosen], level[order[chosen]]


def _triangle(hash_: np.ndarray, own: np.ndarray, parts: np.ndarray):
    """Copies of rows for the cells of a triangle of ``parts``: (row, hash of the cell); two rows of a word meet in at least one."""
    row = np.repeat(np.arange(len(hash_)), parts)
    step = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
    low, high = np.minimum(step, own[row]), np.maximum(step, own[row])
    return row, np.where(parts[row] > 1, mix(hash_[row] + mix(low.astype(np.uint64) * _SALT + high.astype(np.uint64))), hash_[row])


def _prefixes(batches, shared, threshold: float, least: int, bins: int, flush: int = 1_000_000):
    """Prefix rows as columnar blocks, one for each bin and flush."""
    rank, seen = shared.value, Seen()
    many = np.maximum(1, np.ceil(np.exp2(np.arange(256) / 8) / HOT)).astype(np.int64)
    held, lines, size = [], 0, 0
    for batch in batches:
        for part in slices(batch, "text", 1 << 20):
            sets = LineSets(part.column(1), least)
            sets.keep(seen.new(sets.cls))
            sets.keep(np.flatnonzero(sets.n >= threshold * (sets.n + 1) - 1e-9))  # n words can at best match n + 1
            if not len(sets.n):
                continue
            token, line, pos, level = _prefix_rows(sets, rank, threshold)
            parts = many[level]
            if (parts > 1).any():
                row, token = _triangle(token, (mix(sets.cls[line].astype(np.uint64)) % parts.astype(np.uint64)).astype(np.int64), parts)
                line, pos = line[row], pos[row]
            held.append((token, line + lines, pos, sets.cls, sets.n, bitmaps(sets)[0]))
            lines, size = lines + len(sets.n), size + len(token)
            if size >= flush:
                yield _packed(held, bins)
                held, lines, size = [], 0, 0
    if held:
        yield _packed(held, bins)


def _packed(held: list, bins: int) -> pa.RecordBatch:
    cell, line, pos, cls, n, bits = (np.concatenate(x) for x in zip(*held, strict=True))
    bin_ = (cell % np.uint64(bins)).astype(np.int64)
    key = (cell >> np.uint64(32)).astype(np.uint32)
    order = np.argsort((bin_.astype(np.uint64) << np.uint64(32)) | key)
    line = line[order]
    lanes = lanes_of(n)
    entry, _ = expand(np.r_[0, np.cumsum(lanes)].astype(np.int64), line)
    cls, n, lanes = cls[line], n[line], lanes[line]
    start = np.flatnonzero(np.r_[True, np.diff(bin_[order]) > 0])
    ends = np.r_[start, len(order)]

    def binary(values: np.ndarray, at: np.ndarray) -> pa.Array:
        return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer((at * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])

    least = lambda x: x.astype(np.uint8 if x.max() < 256 else np.uint16 if x.max() < 65536 else np.uint32)
    lane_ends = np.r_[0, np.cumsum(lanes)][ends]
    columns = [binary(key[order], ends), binary(cls, ends), binary(least(n), ends), binary(least(pos[order]), ends), binary(bits[entry], lane_ends)]
    return pa.RecordBatch.from_arrays([pa.array(bin_[order][start], pa.int32()), pa.array(np.diff(ends), pa.int32()), *columns], schema=_BLOCKS)


class Bucket:
    """The rows of whole bins, each class once a word, in order of (word, size)."""

    def __init__(self, table: pa.Table):
        rows = table.column("n_rows").to_numpy().astype(np.int64)
        key, cls, n, pos, bits = [], [], [], [], []
        for i, (k, c, x, y, z) in enumerate(zip(*(table.column(m).to_pylist() for m in ("key", "cls", "n", "pos", "bits")), strict=True)):
            kind = lambda raw, m=rows[i]: np.frombuffer(raw, f"<u{len(raw) // m}").astype(np.int64)
            key.append(kind(k))
            cls.append(np.frombuffer(c, np.int64))
            n.append(kind(x))
            pos.append(kind(y))
            bits.append(np.frombuffer(z, np.uint64))
        key, cls, n, pos, self.bits = (np.concatenate(x) for x in (key, cls, n, pos, bits))
        code = (key.astype(np.uint64) << np.uint64(32)) | (np.minimum(n, 65535).astype(np.uint64) << np.uint64(16)) | (cls & 65535).astype(np.uint64)
        order = np.argsort(code)
        k, c = key[order], cls[order]
        order = order[np.r_[True, (k[1:] != k[:-1]) | (c[1:] != c[:-1])]]
        # words of one class only have no pairs
        k = key[order]
        alone = np.r_[True, k[1:] != k[:-1]] & np.r_[k[1:] != k[:-1], True]
        order = order[~alone]
        self.code, self.cls, self.n, self.pos = code[order], cls[order], n[order], pos[order]
        lanes = lanes_of(n)
        self.lanes, self.at = lanes[order], (np.cumsum(lanes) - lanes)[order]

    def folded(self, rows: np.ndarray, wide: int) -> np.ndarray:
        """The rows' bitmaps, folded to ``wide`` lanes."""
        lane = np.arange(wide)
        out, step = self.bits[self.at[rows][:, None] + lane], wide
        more = np.flatnonzero(self.lanes[rows] > step)
        while len(more):
            out[more] ^= self.bits[self.at[rows[more]][:, None] + step + lane]
            step += wide
            more = more[self.lanes[rows[more]] > step]
        return out

    def pairs(self, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, row of a class of at most its size), in blocks: those whose sizes and places leave enough words, with few others.

        The overlap that two sets need is at least that of two sets of the smaller
        size, so a row can only be the smaller one's near the head of its set; and the
        deeper a row lies in its own, the fewer words the other may have.
        """
        rows = np.arange(len(self.code))
        share = threshold / (1 + threshold)
        vast = self.n >= 65535  # these aren't in order of their sizes
        head = np.flatnonzero(vast | (self.n - self.pos >= needed(self.n, self.n, threshold)))
        word = self.code & np.uint64(0xFFFFFFFF << 32)
        shortest = np.minimum(65535, np.ceil(threshold * self.n - 1e-9)).astype(np.uint64)
        longest = np.where(vast, np.inf, np.floor((self.n - self.pos) / share - self.n + 1e-6))
        low = np.searchsorted(self.code, word | (shortest << np.uint64(16)))
        high = np.searchsorted(self.code, word | (np.clip(longest + 1, 0, 65535).astype(np.uint64) << np.uint64(16)))
        high = np.where(longest < self.n, high, rows)
        low, high = np.searchsorted(head, low), np.searchsorted(head, high)
        count = np.maximum(0, high - low)
        ends = np.cumsum(count)
        at = 0
        while at < len(rows):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 1_000_000, "right")))
            c = np.repeat(rows[at:stop], count[at:stop])
            yield c, head[low[c] + np.arange(len(c)) - np.repeat(ends[at:stop] - count[at:stop] - (ends[at - 1] if at else 0), count[at:stop])]
            at = stop

    def alike(self, c: np.ndarray, e: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """The pairs that pass the length, positional and bitmap filters."""
        n, m = self.n[c], self.n[e]
        least = needed(n, m, threshold)
        ok = (np.minimum(n - self.pos[c], m - self.pos[e]) >= least) & (np.minimum(n, m) >= threshold * np.maximum(n, m) - 1e-9)
        c, e, spare = c[ok], e[ok], (n + m - 2 * least)[ok]
        lanes, near = np.minimum(self.lanes[c], self.lanes[e]), np.zeros(len(c), bool)
        for wide in _WIDTHS:
            some = np.flatnonzero(lanes == wide)
            near[some] = np.bitwise_count(self.folded(c[some], wide) ^ self.folded(e[some], wide)).sum(axis=1) <= spare[some]
        return c[near], e[near]


def _forest(batches, threshold: float):
    """Links (class, least class) of a spanning forest of the pairs that pass the filters, for each bin."""
    schema = pa.schema([("cls", pa.int64()), ("other", pa.int64())])
    for table in whole_groups(batches, "bin"):
        b = Bucket(table)
        names, ids = np.unique(b.cls, return_inverse=True)
        label = np.arange(len(names))
        for c, e in b.pairs(threshold):
            apart = label[ids[c]] != label[ids[e]]
            c, e = b.alike(c[apart], e[apart], threshold)
            unite(label, ids[c], ids[e])
        led = np.flatnonzero(label != np.arange(len(names)))
        yield pa.RecordBatch.from_arrays([pa.array(names[led]), pa.array(names[label[led]])], schema=schema)
        del table, b
        release()


def _wanted_sets(batches, shared, firsts, least: int):
    """The word sets of the classes that the filter may hold, each once a task, from the documents that may hold a first line."""
    schema = pa.schema([("cls", pa.int64()), ("tokens", pa.binary())])
    held, seen = shared.value, Seen()
    for batch in batches:
        for part in slices(batch, "text"):
            part = part.filter(pa.array(firsts.value.holds(part.column(0).to_numpy())))
            sets = LineSets(part.column(1), least)
            hit = np.flatnonzero(held.holds(sets.cls))
            sets.keep(hit[seen.new(sets.cls[hit])])
            tokens = pa.Array.from_buffers(pa.binary(), len(sets.n), [None, pa.py_buffer((sets.first * 8).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(sets.token))])
            yield pa.RecordBatch.from_arrays([pa.array(sets.cls), tokens], schema=schema)


LINKS = "cls bigint, doc bigint, line int, degree bigint, e_doc bigint, e_line int, root_doc bigint"
_LINKS = pa.schema([("cls", pa.int64()), ("doc", pa.int64()), ("line", pa.int32()), ("degree", pa.int64()), ("e_doc", pa.int64()), ("e_line", pa.int32()), ("root_doc", pa.int64())])


class Cells:
    """Word sets of whole cells, each class once a cell, in order of (cell, first place)."""

    def __init__(self, table: pa.Table):
        get = lambda c: table.column(c).to_numpy()
        cell, cls, doc, line = get("cell"), get("cls"), get("doc"), get("line")
        order = np.lexsort((cls, line, doc, cell))
        k, c = cell[order], cls[order]
        order = order[np.r_[True, (k[1:] != k[:-1]) | (c[1:] != c[:-1])]]
        self.cell, self.cls, self.doc, self.line = cell[order], cls[order], doc[order], line[order]
        self.part = get("part")[order]  # -1 where every pair counts; else only pairs of different parts
        sets = [np.frombuffer(x, np.uint64) for x in table.column("tokens").take(pa.array(order)).to_pylist()]
        self.n = np.array([len(x) for x in sets], np.int64)
        self.first = np.r_[0, np.cumsum(self.n)].astype(np.int64)
        self.token = np.unique(np.concatenate(sets), return_inverse=True)[1] if sets else np.zeros(0, np.int64)

    def reached(self, both: np.ndarray, x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
        return both >= threshold * (self.n[x] + self.n[y] - both) - 1e-9

    def small(self, rows: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Linked pairs within the cells of ``rows``, each way, of cells with few classes."""
        cell = self.cell[rows]
        start = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        count = np.arange(len(rows)) - np.repeat(start, np.diff(np.r_[start, len(rows)]))
        c = np.repeat(np.arange(len(rows)), count)
        e = rows[c - 1 - (np.arange(len(c)) - np.repeat(np.cumsum(count) - count, count))]
        c = rows[c]
        ok = (np.minimum(self.n[c], self.n[e]) >= threshold * np.maximum(self.n[c], self.n[e]) - 1e-9) & self.counts(c, e)
        c, e = c[ok], e[ok]
        top = int(self.token.max(initial=0)) + 1
        held = np.sort(np.repeat(np.arange(len(self.n)), self.n) * top + self.token)
        both = np.zeros(len(c), np.int64)
        for at in range(0, len(c), 50_000):
            x, y = c[at : at + 50_000], e[at : at + 50_000]
            entry, pair = expand(self.first, x)
            wanted = y[pair] * top + self.token[entry]
            found = held[np.minimum(np.searchsorted(held, wanted), len(held) - 1)] == wanted
            both[at : at + 50_000] = np.bincount(pair[found], minlength=len(x))
        ok = self.reached(both, c, e, threshold)
        return np.r_[c[ok], e[ok]], np.r_[e[ok], c[ok]]

    def counts(self, c: np.ndarray, e: np.ndarray) -> np.ndarray:
        return (self.part[c] < 0) | (self.part[c] != self.part[e])

    def large(self, rows: np.ndarray, threshold: float) -> np.ndarray:
        """Which of a cell's classes are linked, as a matrix: overlaps of frequent words by matrix products, of the others word by word."""
        k = len(rows)
        entry, owner = expand(self.first, rows)
        names, token, times = np.unique(self.token[entry], return_inverse=True, return_counts=True)
        both = np.zeros((k, k), np.float32)
        often = np.flatnonzero(times > 64)
        column = np.full(len(names), -1)
        column[often] = np.arange(len(often))
        for at in range(0, len(often), 1024):
            some = (column[token] >= at) & (column[token] < at + 1024)
            x = np.zeros((k, min(1024, len(often) - at)), np.float32)
            x[owner[some], column[token[some]] - at] = 1
            both += x @ x.T
        some = np.flatnonzero((times[token] > 1) & (times[token] <= 64))
        some = some[np.argsort(token[some], kind="stable")]
        t, o = token[some], owner[some]
        start = np.flatnonzero(np.r_[True, t[1:] != t[:-1]]) if len(t) else np.zeros(0, np.int64)
        before = np.arange(len(t)) - np.repeat(start, np.diff(np.r_[start, len(t)]))
        for step in range(1, int(before.max(initial=0)) + 1):
            i = np.flatnonzero(before >= step)
            np.add.at(both, (o[i], o[i - step]), 1)
            np.add.at(both, (o[i - step], o[i]), 1)
        n = self.n[rows].astype(np.float64)
        out = np.zeros((k, k), bool)
        for at in range(0, k, 256):
            part = both[at : at + 256].astype(np.float64)
            out[at : at + 256] = part >= threshold * (n[at : at + 256, None] + n[None] - part) - 1e-9
        np.fill_diagonal(out, False)
        if k and self.part[rows[0]] >= 0:
            out &= self.part[rows][:, None] != self.part[rows][None]
        return out


def _decide(batches, threshold: float, few: int = 48):
    """Every pair of each cell, decided on whole sets; a row for each class with a link."""
    for table in whole_groups(batches, "cell"):
        cells = Cells(table)
        start = np.flatnonzero(np.r_[True, cells.cell[1:] != cells.cell[:-1]])
        width = np.diff(np.r_[start, len(cells.cell)])
        total = len(cells.cell)
        degree, earliest, root = np.zeros(total, np.int64), np.full(total, total), np.arange(total)
        c, e = cells.small(np.flatnonzero(np.repeat(width <= few, width)), threshold)
        degree += np.bincount(c, minlength=total)
        np.minimum.at(earliest, c, e)
        unite(root, c, e)
        for s, w in zip(start[width > few].tolist(), width[width > few].tolist(), strict=True):
            linked = cells.large(np.arange(s, s + w), threshold)
            degree[s : s + w] = linked.sum(axis=1)
            earliest[s : s + w] = np.where(linked.any(axis=1), s + linked.argmax(axis=1), total)
            label = np.arange(w)
            while True:
                near = np.array([label[x].min(initial=w) for x in linked])
                new = np.minimum(label, near)
                new = new[new]
                if (new == label).all():
                    break
                label = new
            root[s : s + w] = s + label
        some = np.flatnonzero(degree)
        near = earliest[some]
        yield pa.RecordBatch.from_arrays([pa.array(cells.cls[some]), pa.array(cells.doc[some]), pa.array(cells.line[some], pa.int32()), pa.array(degree[some]), pa.array(cells.doc[near]), pa.array(cells.line[near], pa.int32()), pa.array(cells.doc[root[some]])], schema=_LINKS)
        release()


@dataclass
class LineJoin:
    """The join's results: ``hits``, the lines (cls, doc, line) whose class is repeated or linked, with its first place, times, degree and earliest linked place ``e``; ``near`` pairs of documents that linked classes connect."""

    hits: DataFrame
    near: DataFrame
    ids: DataFrame | None
    key: str


def join_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.8, least: int = 5) -> LineJoin:
    """Every link between the lines of ``df``."""
    (key,) = fresh(df, "doc_key")
    docs, ids = numbered(df.select(doc_id, text), doc_id, key)
    return _joined(docs.select(F.col(key).alias("doc"), F.col(text).alias("text"), F.xxhash64(text).alias("row")), threshold, least, ids, key)


def _joined(docs: DataFrame, threshold: float, least: int, ids: DataFrame | None, key: str) -> LineJoin:
    spark = docs.sparkSession
    send = spark.sparkContext.broadcast
    scan = materialise(docs.mapInArrow(partial(_scan, least=least), SCAN), "line-scan")
    rank = send(levels(merged(scan.where("kind = 1").select("block", "counts"), CELLS)))  # one byte a cell: 1 MB
    lines = scan.where("kind = 0").select("cls", "doc", "row", "line")
    firsts = lines.groupBy("cls").agg(F.min(F.struct("doc", "line")).alias("first"), F.count(F.lit(1)).alias("times"))
    firsts = materialise(firsts.select("cls", "first.doc", "first.line", "times"), "line-firsts")
    bins = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select("doc", "text")
    dealt = texts.mapInArrow(lambda x: _prefixes(x, rank, threshold, least, bins), BLOCKS).repartitionById(bins, F.col("bin")).sortWithinPartitions("bin")
    forest = dealt.mapInArrow(partial(_forest, threshold=threshold), "cls bigint, other bigint")
    groups = materialise(components(forest), "line-groups")
    held = send(bloom(groups.select("node"), groups.count()))  # 16 MB at most
    sizes = groups.groupBy("comp").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > WIDE).select("comp", F.ceil(F.col("n") / WIDE).cast("int").alias("parts"))
    places = groups.withColumnRenamed("node", "cls").join(firsts.drop("times"), "cls").join(sizes, "comp", "left")
    own = F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int")
    triangle = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda i: F.struct(F.least(i, F.col("own")).alias("i"), F.greatest(i, F.col("own")).alias("j")))
    whole = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))
    spread = places.withColumn("own", own).withColumn("at", F.explode(F.when(F.col("parts").isNull(), whole).otherwise(triangle)))
    spread = spread.select("cls", "doc", "line", F.xxhash64("comp", "at.i", "at.j").alias("cell"), F.when(F.col("at.i") < F.col("at.j"), F.col("own")).otherwise(F.lit(-1)).alias("part"))
    spread = materialise(spread, "line-cells")
    there = send(bloom(spread.select("doc"), spread.count()))  # 16 MB at most
    sets = texts.mapInArrow(lambda x: _wanted_sets(x, held, there, least), "cls bigint, tokens binary")
    rows = sets.join(spread, "cls").select("cell", "part", "cls", "doc", "line", "tokens")
    decided = rows.repartition(F.col("cell")).sortWithinPartitions("cell").mapInArrow(partial(_decide, threshold=threshold), LINKS)
    links = materialise(decided, "line-links")
    degrees = links.groupBy("cls").agg(F.sum("degree").alias("degree"), F.min(F.struct("e_doc", "e_line")).alias("e"))
    classes = firsts.join(degrees, "cls", "left").where("times > 1 or degree is not null")
    classes = materialise(classes.select("cls", F.struct("doc", "line").alias("first"), "times", F.coalesce("degree", F.lit(0)).alias("degree"), F.col("e").alias("e")), "line-classes")
    hits = materialise(lines.join(classes, "cls"), "line-hits")
    return LineJoin(hits, links.select("doc", F.col("root_doc").alias("other")), ids, key)


def removals(joined: LineJoin) -> DataFrame:
    """A row for each document that loses lines: doc, row (the hash of its text), gone (line numbers), n_near (how many of them only a similar line precedes), and source, the document of the earliest such line."""
    here = F.struct("doc", "line")
    e = F.when(F.col("e").isNotNull(), F.struct(F.col("e.e_doc").alias("doc"), F.col("e.e_line").alias("line")))
    hit = joined.hits.withColumn("later", here > F.col("first")).withColumn("near", F.coalesce(e < here, F.lit(False))).where("later or near")
    source = F.least(F.when(F.col("later"), F.col("first.doc")), F.when(F.col("near"), F.col("e.e_doc")))
    near = F.size(F.collect_set(F.when(~F.col("later"), F.col("line"))))  # sets, as copies of a row list their lines each
    return hit.groupBy("doc", "row").agg(F.collect_set("line").alias("gone"), near.cast("bigint").alias("n_near"), F.min(source).alias("source"))


def dedup_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.8, least: int = 5, joined: LineJoin | None = None) -> DataFrame:
    """The documents with their later lines removed from ``text``; appends n_lines (before), n_removed, n_near (of these, by similarity alone) and first_doc (the lowest document that a removed line repeats).

    ``joined`` is the result of ``join_lines`` over the same documents, where it is at hand.
    """
    with tables_made() as made:
        own = joined is None
        joined = joined or join_lines(df, doc_id, text, threshold, least)
        lost = materialise(removals(joined), "line-removals")
    if own:  # nothing else reads the join's tables
        drop_tables(df.sparkSession, made, but=[lost, joined.ids])
    held = df.sparkSession.sparkContext.broadcast(bloom(lost.select("doc"), lost.count()))  # 16 MB at most

    @F.pandas_udf("boolean")
    def may_lose(doc: pd.Series) -> pd.Series:
        return pd.Series(held.value.holds(doc.to_numpy(np.int64)))

    names = ["n_lines", "n_removed", "n_near", "first_doc"]
    df = df.drop(*[n for n in names if n != doc_id])
    key, row, may, gone, near, source, parts = fresh(df, "doc_key", "row_key", "may_lose", "gone_", "near_", "source_", "parts_")
    flagged = _with_key(df, doc_id, key, joined).withColumn(may, may_lose(key)).withColumn(row, F.xxhash64(text))
    order = [*[c for c in df.columns if c not in names], *names]
    # texts that lose nothing stay where they are; only the others are shuffled to their removals
    plain = F.coalesce(text, F.lit(""))
    whole = flagged.where(~F.col(may)).withColumn("n_lines", (F.length(plain) - F.length(F.replace(plain, F.lit("\n"), F.lit(""))) + 1).cast("bigint"))
    whole = whole.withColumns({"n_removed": F.lit(0).cast("bigint"), "n_near": F.lit(0).cast("bigint"), "first_doc": F.lit(None).cast("bigint")})
    some = flagged.where(may).join(lost.toDF(key, row, gone, near, source), [key, row], "left").withColumn(parts, F.split(plain, "\n", -1))
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(gone))  # by a hash set, so linear in the lines
    kept = F.array_join(F.transform(left, lambda i: F.get(F.col(parts), i)), "\n")
    some = some.withColumns({text: F.when(F.col(gone).isNull(), F.col(text)).otherwise(kept), "n_lines": F.size(parts).cast("bigint"), "n_removed": F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).cast("bigint"), "n_near": F.coalesce(F.col(near), F.lit(0).cast("bigint")), "first_doc": F.col(source)})
    out = whole.select(*order).unionByName(some.select(*order))
    return renamed_ids(out, joined.ids, "first_doc", joined.key)


def _with_key(df: DataFrame, doc_id: str, key: str, joined: LineJoin) -> DataFrame:
    if joined.ids is None:
        return df.withColumn(key, F.coalesce(F.col(doc_id).cast("bigint"), F.lit(LOWEST)))
    return df.join(joined.ids.withColumnRenamed(joined.key, key), doc_id, "left").select(*df.columns, F.coalesce(key, F.lit(LOWEST)).alias(key))


def with_links(df: DataFrame, joined: LineJoin, doc_id: str = "doc_id") -> DataFrame:
    """Appends class_id, the lowest document that is connected by equal or similar lines over any number of steps, and n_links, the lines that have equal ones plus the links of the document's different lines to other sets."""
    same = joined.hits.groupBy("doc", "cls").agg(F.count(F.lit(1)).alias("k"), F.first("first.doc").alias("v"), F.first("times").alias("times"), F.first("degree").alias("degree"))
    members = materialise(same.select("doc", "v", (F.when(F.col("times") > 1, F.col("k")).otherwise(0) + F.col("degree")).alias("links")), "line-members")
    groups = components(members.select(F.col("doc").alias("cls"), F.col("v").alias("other")).unionByName(joined.near.withColumnRenamed("doc", "cls")))
    totals = members.groupBy("doc").agg(F.sum("links").alias("links"))
    df = df.drop(*[n for n in ("class_id", "n_links") if n != doc_id])
    key, node, doc, links = fresh(df, "doc_key", "node_key", "links_key", "links")
    out = _with_key(df, doc_id, key, joined).join(totals.toDF(doc, links), F.col(key) == F.col(doc), "left")
    out = out.join(groups.select(F.col("node").alias(node), F.col("comp").alias("class_id")), F.col(key) == F.col(node), "left")
    out = out.select(*df.columns, F.coalesce("class_id", key).alias("class_id"), F.coalesce(F.col(links), F.lit(0)).cast("bigint").alias("n_links"))
    return renamed_ids(out, joined.ids, "class_id", joined.key)


def linked_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.8, least: int = 5) -> DataFrame:
    """``dedup_lines`` with class_id and n_links appended."""
    joined = join_lines(df, doc_id, text, threshold, least)
    return with_links(dedup_lines(df, doc_id, text, threshold, least, joined), joined, doc_id)


__all__ = ["LineJoin", "dedup_lines", "join_lines", "linked_lines", "removals", "with_links"]
