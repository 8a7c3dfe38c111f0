"""Near-duplicate documents by ProbMinHash.

A document is its set of word 5-grams (the whole text where it is shorter),
weighted by 1 + ln(count).  Signatures are ProbMinHash: every element draws the
arrivals of a Poisson process whose rate is its weight, each arrival goes to a
random register, a register keeps the element of its earliest arrival, and an
element stops once its next arrival is later than all registers.  Two registers
agree with the probability Jaccard similarity of the documents.

1. Equal word sequences are one class, whatever their number; only classes go on.
2. Registers are cut into bands.  Buckets of up to ``small`` classes send all
   pairs that pass the size filter and a one-bit-per-register sketch.  In larger
   ones a class sends its first such predecessor only, so a group of thousands of
   near copies sends one row a class.
3. Pairs are verified by the exact Jaccard similarity of the 5-gram sets.
4. Components are found by contracting each node's neighbourhood, round by round.
5. Larger buckets that still hold several components are compared again, across
   components, in blocks of bounded width; pairs are verified inside the block and
   only links leave it, so no link between components is lost.

Documents without words are never duplicates.  Null text counts as empty.  Rows
are grouped whatever their ids; the class id is the lowest doc_id of the group
(null doc_ids count only where there is no other).  Words and 5-grams are known
by hashes: 64 bits for whole texts, 40 in sets and the final check.  Ids may be of
any type that sorts.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from .common import LOWEST, drop_tables, fresh, materialise, numbered, renamed_ids, tables_made, with_arrow
from .decontaminate import expand, grams
from .groups import components, whole_groups
from .scan import mix, release, slices, words
from .sketch import bloom

BANDS, ROWS = 24, 5
REGISTERS = BANDS * ROWS
SMALL = 16
WIDE = 2048
APART = 30  # registers whose bits may differ: six standard deviations at a similarity of 0.8
_STEP = np.uint64(0xD1342543DE82EF95)
BAND_ROWS = "key bigint, cls bigint, size int, low bigint, high bigint"
FOUND = "kind int, cls bigint, other bigint, size int, low bigint, high bigint"


class Shingles:
    """The 5-gram sets of one slice of documents; documents without words have none."""

    def __init__(self, column: pa.Array, size: int = 5):
        w = words(column)
        total = np.diff(w.first)
        whole = grams(w.hash, size) if len(w.hash) >= size else np.zeros(0, np.uint64)
        n = np.maximum(0, total - size + 1)
        entry, owner = expand(np.r_[0, np.cumsum(total)].astype(np.int64), np.arange(len(total)))
        inside = entry - w.first[:-1][owner] < n[owner]
        hashes, docs = whole[entry[inside]], owner[inside]
        short = np.flatnonzero((total > 0) & (total < size))
        if len(short):
            hashes = np.r_[hashes, np.concatenate([grams(w.hash[w.first[d] : w.first[d + 1]], size) for d in short])]
            docs = np.r_[docs, short]
        key = np.sort((docs.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        self.count = np.diff(np.r_[start, len(key)])
        self.doc = (key[start] >> np.uint64(40)).astype(np.int64)
        self.gram = key[start] & np.uint64((1 << 40) - 1)
        self.n = np.bincount(self.doc, minlength=len(total))
        self.first = np.r_[0, np.cumsum(self.n)].astype(np.int64)
        place = np.arange(len(w.hash), dtype=np.uint64) - w.first[w.doc].astype(np.uint64)
        sums = np.zeros(len(total), np.uint64)
        some = np.flatnonzero(total)
        if len(some):
            sums[some] = np.add.reduceat(mix(w.hash + mix(place * _STEP)), w.first[some])
        self.cls = mix(sums ^ total.astype(np.uint64)).astype(np.int64)

    def firsts(self) -> np.ndarray:
        """One document of each class that has any words."""
        some = np.flatnonzero(self.n)
        return np.sort(some[np.unique(self.cls[some], return_index=True)[1]])


def signatures(s: Shingles, registers: int = REGISTERS, chosen: np.ndarray | None = None) -> np.ndarray:
    """ProbMinHash registers (element hashes) of the chosen documents, all rows at once, a round for each arrival."""
    chosen = s.firsts() if chosen is None else chosen
    entry, owner = expand(s.first, chosen)
    gram, weight = s.gram[entry], 1 + np.log(s.count[entry])
    earliest = np.full(len(chosen) * registers, np.inf)
    held = np.zeros(len(chosen) * registers, np.uint64)
    x, turn = np.zeros(len(gram)), 0
    latest = np.full(len(chosen), np.inf)
    while len(gram):
        turn += 1
        draw = mix(gram + np.uint64(turn * int(_STEP) % (1 << 64)))
        x = x - np.log1p(-(draw >> np.uint64(11)).astype(np.float64) * 2.0**-53) / weight
        live = x < latest[owner]
        gram, weight, owner, x, draw = gram[live], weight[live], owner[live], x[live], draw[live]
        slot = owner * registers + (mix(draw) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(earliest, slot, x)
        won = earliest[slot] == x
        held[slot[won]] = gram[won]
        docs = np.unique(owner)
        latest[docs] = earliest.reshape(-1, registers)[docs].max(axis=1)
    return held.reshape(-1, registers)


def _bands(batches):
    schema = pa.schema([("key", pa.int64()), ("cls", pa.int64()), ("size", pa.int32()), ("low", pa.int64()), ("high", pa.int64())])
    place = np.arange(REGISTERS, dtype=np.uint64)
    for batch in batches:
        for part in slices(batch, "text", 1 << 20):
            s = Shingles(part.column(1))
            chosen = s.firsts()
            held = signatures(s, chosen=chosen)
            mixed = mix(held + place * _STEP)
            bits = np.packbits((mixed & np.uint64(1)).astype(np.uint8), axis=1, bitorder="little")
            wide = np.zeros((len(chosen), 16), np.uint8)
            wide[:, : bits.shape[1]] = bits
            wide = wide.view(np.int64)
            key = np.zeros((len(chosen), BANDS), np.uint64)
            for r in range(ROWS):
                key = mix(key + mixed.reshape(-1, BANDS, ROWS)[:, :, r])
            again = lambda c: np.repeat(c, BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel().astype(np.int64)), pa.array(again(s.cls[chosen])), pa.array(again(s.n[chosen]), pa.int32()), pa.array(again(wide[:, 0])), pa.array(again(wide[:, 1]))], schema=schema)


class Buckets:
    """Rows of whole buckets, each class once, in order of (key, class)."""

    def __init__(self, table: pa.Table):
        get = lambda c: table.column(c).to_numpy()
        key, cls = get("block" if "block" in table.column_names else "key"), get("cls")
        order = np.lexsort((cls, key))
        k, c = key[order], cls[order]
        order = order[np.r_[True, (k[1:] != k[:-1]) | (c[1:] != c[:-1])]]
        self.key, self.cls, self.size = key[order], cls[order], get("size")[order].astype(np.int64)
        self.low, self.high = get("low")[order].view(np.uint64), get("high")[order].view(np.uint64)
        self.comp = get("comp")[order] if "comp" in table.column_names else None
        start = np.flatnonzero(np.r_[True, self.key[1:] != self.key[:-1]])
        width = np.diff(np.r_[start, len(order)])
        self.start, self.width = np.repeat(start, width), np.repeat(width, width)

    def alike(self, c: np.ndarray, e: np.ndarray, threshold: float) -> np.ndarray:
        n, m = self.size[c], self.size[e]
        ok = np.minimum(n, m) >= threshold * np.maximum(n, m) - 1e-9
        apart = np.bitwise_count(self.low[c] ^ self.low[e]).astype(np.int64) + np.bitwise_count(self.high[c] ^ self.high[e])
        return ok & (apart <= APART)

    def pairs(self, rows: np.ndarray, low: int, high: int):
        """(row, predecessor) for predecessors number low to high of each row's bucket, in blocks."""
        reach = np.maximum(0, np.minimum(rows - self.start[rows], high) - low)
        at = 0
        ends = np.cumsum(reach)
        while at < len(rows):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 1_000_000, "right")))
            part = rows[at:stop]
            count = reach[at:stop]
            owner = np.repeat(np.arange(len(part)), count)
            step = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            yield part[owner], self.start[part][owner] + low + step
            at = stop


_SCHEMA = pa.schema([("kind", pa.int32()), ("cls", pa.int64()), ("other", pa.int64()), ("size", pa.int32()), ("low", pa.int64()), ("high", pa.int64())])


def _first_round(batches, threshold: float):
    """Kind 0: a pair to verify.  Kind 1: a class of a larger bucket (other: the bucket)."""
    sent: set = set()
    for table in whole_groups(batches, "key"):
        release()
        b = Buckets(table)
        rows = np.arange(len(b.key))
        found = []
        for c, e in b.pairs(rows[b.width <= SMALL], 0, SMALL):
            ok = b.alike(c, e, threshold)
            found.append((c[ok], e[ok]))
        large = rows[b.width > SMALL]
        active, low, high = large[large > b.start[large]], 0, 16
        while len(active):
            done = np.zeros(len(rows), bool)
            for c, e in b.pairs(active, low, high):
                ok = b.alike(c, e, threshold)
                c, e = c[ok], e[ok]
                first = np.r_[True, c[1:] != c[:-1]] if len(c) else np.zeros(0, bool)
                done[c] = True
                found.append((c[first], e[first]))
            low, high = high, high * 4
            active = active[~done[active] & (active - b.start[active] > low)]
        c, e = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (rows[:0], rows[:0])
        pairs = list(zip(b.cls[c].tolist(), b.cls[e].tolist(), strict=True))
        if len(sent) > 100_000:
            sent.clear()
        new = [i for i, p in enumerate(pairs) if p not in sent and not sent.add(p)]
        c, e = c[new], e[new]
        kind = np.r_[np.zeros(len(c), np.int32), np.ones(len(large), np.int32)]
        some = np.r_[c, large]
        yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(b.cls[some]), pa.array(np.r_[b.cls[e], b.key[large]]), pa.array(b.size[some], pa.int32()), pa.array(b.low[some].view(np.int64)), pa.array(b.high[some].view(np.int64))], schema=_SCHEMA)
    del sent
    release()


def _across(batches, threshold: float):
    """Links between components within blocks of larger buckets: pairs that pass the filters are verified here, so only links leave the task."""
    schema = pa.schema([("cls", pa.int64()), ("other", pa.int64())])
    failed: set = set()
    for table in whole_groups(batches, "block"):
        b = Buckets(table)
        sets = dict(zip(table.column("cls").to_pylist(), table.column("grams").to_pylist(), strict=True))
        root: dict[int, int] = {}

        def find(x: int, root=root) -> int:
            while root.get(x, x) != x:
                x = root[x]
            return x

        links = []
        for c, e in b.pairs(np.arange(len(b.key)), 0, 1 << 62):
            apart = b.comp[c] != b.comp[e]
            c, e = c[apart], e[apart]
            ok = b.alike(c, e, threshold)
            for i, j in zip(c[ok].tolist(), e[ok].tolist(), strict=True):
                u, v = int(b.cls[i]), int(b.cls[j])
                x, y = find(int(b.comp[i])), find(int(b.comp[j]))
                if x == y or (u, v) in failed:
                    continue
                if jaccard(np.frombuffer(sets[u], "<u8"), np.frombuffer(sets[v], "<u8")) >= threshold - 1e-9:
                    root[x] = y
                    links.append((u, v))
                else:
                    if len(failed) > 500_000:
                        failed.clear()
                    failed.add((u, v))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], schema=schema)


def _wanted(batches, shared):
    schema = pa.schema([("cls", pa.int64()), ("grams", pa.binary())])
    held = shared.value
    for batch in batches:
        for part in slices(batch, "text"):
            s = Shingles(part.column(1))
            chosen = s.firsts()
            chosen = chosen[held.holds(s.cls[chosen])]
            entry, _ = expand(s.first, chosen)
            packed = s.gram[entry].astype("<u8")
            ends = np.r_[0, np.cumsum(s.n[chosen])].astype(np.int32) * 8
            yield pa.RecordBatch.from_arrays([pa.array(s.cls[chosen]), pa.Array.from_buffers(pa.binary(), len(chosen), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(packed)])], schema=schema)


def jaccard(x: np.ndarray, y: np.ndarray) -> float:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / max(1, len(x) + len(y) - both)


def _verify(batches, threshold: float):
    schema = pa.schema([("cls", pa.int64()), ("other", pa.int64())])
    for batch in batches:
        ok = [jaccard(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")) >= threshold - 1e-9 for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], schema=schema).filter(pa.array(ok, pa.bool_()))


def _classes(batches):
    schema = pa.schema([("doc", pa.int64()), ("cls", pa.int64())])
    for batch in batches:
        for part in slices(batch, "text"):
            s = Shingles(part.column(1))
            yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(s.cls, mask=s.n == 0)], schema=schema)


def near_classes(df: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.8) -> DataFrame:
    """(doc_id, class_id, n_class) of every row: the lowest doc_id of its group and the rows in it."""
    docs, ids, key = _docs(df, doc_id, text)
    out = _grouped(docs, threshold).drop("cls")
    for name in ("doc_id", "class_id"):
        out = renamed_ids(out, ids, name, key)
    return out


def _docs(df: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame | None, str]:
    (key,) = fresh(df, "doc_key")
    docs, ids = numbered(df.select(doc_id, text), doc_id, key)
    return docs.select(F.col(key).alias("doc"), F.col(text).alias("text")), ids, key


def _class_of(batch: pa.RecordBatch, column: str) -> list:
    s = Shingles(batch.column(batch.schema.get_field_index(column)))
    return [pa.array(s.cls, mask=s.n == 0)]


def drop_near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.8) -> DataFrame:
    """The rows of ``df`` without near duplicates: of each group the document with the lowest id stays, once."""
    near, doc, gone, times, cls, place = fresh(df, "near_", "doc_", "gone_", "times_", "class_", "place_")
    with tables_made() as made:
        docs, ids, key = _docs(df, doc_id, text)
        lost = _grouped(docs, threshold).where("n_class > 1")
        copies = lost.groupBy("cls", "doc_id").agg(F.min("class_id").alias("class_id"), F.count(F.lit(1)).alias("times"))
        copies = materialise(copies.select(F.col("cls").alias(near), F.col("doc_id").alias(doc), (F.col("doc_id") != F.col("class_id")).alias(gone), F.col("times").alias(times)), "near-copies")
    drop_tables(df.sparkSession, made, but=[copies, ids])
    named = with_arrow(df, [StructField(cls, LongType())], partial(_class_of, column=text), text)
    own = named.join(ids, doc_id, "left").withColumn(key, F.coalesce(key, F.lit(LOWEST))) if ids is not None else named.withColumn(key, F.coalesce(F.col(doc_id).cast("bigint"), F.lit(LOWEST)))
    kept = own.join(copies, (F.col(cls) == F.col(near)) & (F.col(key) == F.col(doc)), "left").where(F.col(gone).isNull() | ~F.col(gone))
    if not copies.where((F.col(times) > 1) & ~F.col(gone)).isEmpty():  # rows that repeat both id and words
        once = kept.where(F.col(times) > 1).withColumn(place, F.row_number().over(Window.partitionBy(cls, doc).orderBy(text))).where(F.col(place) == 1).drop(place)
        kept = kept.where(F.col(times).isNull() | (F.col(times) == 1)).unionByName(once)
    return kept.select(*df.columns)


def _grouped(docs: DataFrame, threshold: float) -> DataFrame:
    spark = docs.sparkSession
    dealt = docs.mapInArrow(_bands, BAND_ROWS).repartition(F.col("key")).sortWithinPartitions("key")
    found = materialise(dealt.mapInArrow(partial(_first_round, threshold=threshold), FOUND), "near-candidates")

    def sets_of(classes: DataFrame) -> DataFrame:
        held = spark.sparkContext.broadcast(bloom(classes, classes.count()))  # 16 MB at most
        return docs.mapInArrow(partial(_wanted, shared=held), "cls bigint, grams binary").groupBy("cls").agg(F.first("grams").alias("grams"))

    pairs = materialise(found.where("kind = 0").select("cls", "other").distinct(), "near-pairs")
    sets = sets_of(pairs.select("cls").unionByName(pairs.select(F.col("other").alias("cls"))))
    one = pairs.join(sets, "cls").select("cls", "other", F.col("grams").alias("a"))
    two = one.join(sets.select(F.col("cls").alias("other"), F.col("grams").alias("b")), "other").select("cls", "other", "a", "b")
    links = materialise(two.mapInArrow(partial(_verify, threshold=threshold), "cls bigint, other bigint"), "near-links")
    comps = components(links)
    members = found.where("kind = 1").select(F.col("other").alias("key"), "cls", "size", "low", "high").dropDuplicates(["key", "cls"])
    if not members.isEmpty():
        named = members.join(comps.withColumnRenamed("node", "cls"), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
        mixed = named.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("n")).where("lo < hi").select("key", F.ceil(F.col("n") / WIDE).cast("int").alias("parts"))
        rest = materialise(named.join(mixed, "key"), "near-mixed")
        if not rest.isEmpty():
            # a bucket of n classes is cut into parts; each pair of parts is a block, so a block holds at most about 2 * WIDE classes
            own = F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int")
            blocks = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda i: F.xxhash64("key", F.least(i, F.col("_own")), F.greatest(i, F.col("_own"))))
            dealt = rest.withColumn("_own", own).withColumn("block", F.explode(blocks)).drop("_own", "parts")
            dealt = dealt.join(sets_of(rest.select("cls")), "cls").repartition(F.col("block")).sortWithinPartitions("block")
            more = materialise(dealt.mapInArrow(partial(_across, threshold=threshold), "cls bigint, other bigint"), "near-across")
            if not more.isEmpty():
                links = materialise(links.unionByName(more), "near-links")
                comps = components(links)
    rows = materialise(docs.mapInArrow(_classes, "doc bigint, cls bigint"), "near-rows")
    # a null id, the lowest key, names a group only where there is no other
    sizes = rows.where("cls is not null").groupBy("cls").agg(F.min(F.when(F.col("doc") != LOWEST, F.col("doc"))).alias("doc"), F.count(F.lit(1)).alias("n"))
    grouped = sizes.join(comps.withColumnRenamed("node", "cls"), "cls", "left").where("n > 1 or comp is not null").withColumn("comp", F.coalesce("comp", "cls"))
    named = grouped.groupBy("comp").agg(F.coalesce(F.min("doc"), F.lit(LOWEST)).alias("class_id"), F.sum("n").alias("n_class"))
    # written first, so that both sides of the join are plain exchanges, whose hot classes can be split
    owner = materialise(grouped.select("cls", "comp").join(named, "comp").select("cls", "class_id", "n_class"), "near-owners")
    out = rows.join(owner, "cls", "left")
    return out.select("cls", F.col("doc").alias("doc_id"), F.when(F.col("n_class").isNull(), F.col("doc")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_class", F.lit(1).cast("bigint")).alias("n_class"))
