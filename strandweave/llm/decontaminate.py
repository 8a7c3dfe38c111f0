"""Benchmark decontamination: BM25 over test items with block-max WAND.

The test items are indexed, the training passages are the queries.  Passages are
windows of ``window`` words, half overlapping.  Scores are divided by the item's
threshold (``share`` of the score that the item's own text gets), so an item is
retrieved where the quotient reaches 1.  A passage goes through

1. the WAND bound: terms whose maxima add up to less than ``slack`` together
   can't lift a passage alone, so only the others (essential terms) open blocks;
2. the block-max bound: per block of items, the essential terms' block maxima
   plus ``slack`` must reach 1;
3. the exact BM25 score of the items of the blocks that are left.

No bound loses an item, and nothing is capped.  All three run vectorised over a
slice of passages.  Retrieved items are verified on the whole document: the
word 5-grams of the item's question and of its answer (the last sentence) must
each be contained in the document by ``overlap`` or more.

Different item texts are indexed, in shards whose text is at most ``shard_bytes``
(checked; a text beyond that is a shard alone), whose indexes are broadcast one after
the other, each against all documents.  The BM25 statistics (number and mean length
of the texts, document frequencies) are taken once over all of them, so scores don't
depend on the shards.  Null texts count as empty; empty items match nothing; equal
items and repeated documents all match; documents keep only their id.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from .common import materialise
from .scan import mix, slices, words

_SPLIT = re.compile(r"[.?!…]\s+(?=\S)|\n+(?=\S)")
GRAM = 5


def grams(hashes: np.ndarray, n: int = GRAM) -> np.ndarray:
    """Hashes of the n-grams of a word sequence (of the whole sequence where it is shorter)."""
    n = min(n, len(hashes))
    if not n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for i in range(n):
        out = mix(out + hashes[i : i + len(out)])
    return out


def split_item(text: str) -> tuple[str, str]:
    """Question and answer: the answer is what follows the last sentence end with at least three words behind it."""
    ends = [m.end() for m in _SPLIT.finditer(text) if len(text[m.end() :].split()) >= 3 and len(text[: m.end()].split()) >= 3]
    return (text[: ends[-1]], text[ends[-1] :]) if ends else (text, "")


def expand(first: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For CSR ``rows``: the entry numbers, and which of ``rows`` each belongs to."""
    count = first[rows + 1] - first[rows]
    owner = np.repeat(np.arange(len(rows)), count)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    return first[rows][owner] + at, owner


@dataclass
class ItemIndex:
    """Inverted index of one shard of items, scores as multiples of the items' thresholds."""

    items: list  # ids
    vocab: np.ndarray  # sorted term hashes
    seen: np.ndarray  # by the low 16 bits of a hash: may it be in vocab?
    first: np.ndarray  # postings of each term: CSR over post_item, post_value
    post_item: np.ndarray
    post_value: np.ndarray
    block_first: np.ndarray  # block maxima of each term: CSR over block_no, block_max
    block_no: np.ndarray
    block_max: np.ndarray
    essential: np.ndarray  # per term
    weak: float  # the most that all other terms can add
    parts: list  # per item: n, and the n-gram hashes of question and answer
    block: int
    window: int


@dataclass
class Statistics:
    """Number and mean length of all item texts, and in how many of them each word of a shard occurs (by sorted hash)."""

    n: int
    mean: float
    vocab: np.ndarray
    times: np.ndarray


def _item_words(batches):
    """(shard, word, n) of each item text: its different words, and its number of words in a row without one."""
    schema = pa.schema([("shard", pa.int32()), ("word", pa.int64()), ("n", pa.int64())])
    for batch in batches:
        for part in slices(batch, "text"):
            w = words(part.column(1))
            shard = part.column(0).to_numpy()
            order = np.lexsort((w.hash, w.doc))
            doc, word = w.doc[order], w.hash[order]
            new = np.r_[True, (doc[1:] != doc[:-1]) | (word[1:] != word[:-1])] if len(doc) else np.zeros(0, bool)
            total = np.diff(w.first)
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[shard[doc[new]], shard], pa.int32()), pa.array(np.r_[word[new].astype(np.int64), np.zeros(len(total), np.int64)], mask=np.r_[np.zeros(int(new.sum()), bool), np.ones(len(total), bool)]), pa.array(np.r_[np.ones(int(new.sum()), np.int64), total])], schema=schema)


def build_index(ids: list, texts: list[str], window: int = 128, share: float = 0.6, block: int = 16, slack: float = 0.35, k1: float = 1.2, b: float = 0.75, stats: Statistics | None = None) -> ItemIndex:
    """The index of ``texts``; ``stats`` are those of all items where these are only some."""
    w = words(pa.array(texts, pa.string()))
    n, length = len(ids), np.diff(w.first).astype(np.float64)
    pairs, tf = np.unique(np.stack([w.hash, w.doc.astype(np.uint64)], axis=1), axis=0, return_counts=True) if len(w.hash) else (np.zeros((0, 2), np.uint64), np.zeros(0))
    vocab, term = np.unique(pairs[:, 0], return_inverse=True)
    item = pairs[:, 1].astype(np.int64)
    df = np.bincount(term, minlength=len(vocab))
    stats = stats or Statistics(n, float(length.mean()) if n else 0.0, vocab, df)
    times = stats.times[np.searchsorted(stats.vocab, vocab)]
    idf = np.log1p((stats.n - times + 0.5) / (times + 0.5))
    value = idf[term] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * length[item] / max(1.0, stats.mean)))
    own = np.bincount(item, weights=value, minlength=n)
    reach = np.minimum(1, (window // 2) / np.maximum(1, length))  # the part of an item that a window surely holds
    value = value / np.maximum(share * own * reach, 1e-9)[item]
    first = np.r_[0, np.cumsum(df)].astype(np.int64)
    key = term * (n // block + 1) + item // block
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    block_max = np.maximum.reduceat(value, start) if len(start) else np.zeros(0)
    block_first = np.searchsorted(term[start], np.arange(len(vocab) + 1))
    top = np.maximum.reduceat(value, first[:-1]) if len(vocab) else np.zeros(0)
    order = np.argsort(top, kind="stable")
    weak = order[np.cumsum(top[order]) < slack]
    essential = np.ones(len(vocab), bool)
    essential[weak] = False
    seen = np.zeros(1 << 16, bool)
    seen[(vocab & np.uint64(0xFFFF)).astype(np.int64)] = True
    parts = []
    for text in texts:
        found = words(pa.array(split_item(text)))
        cut, n = int(found.first[1]), min(GRAM, len(found.hash))
        answer = found.hash[max(0, cut - n + 1) :] if cut < len(found.hash) else found.hash[:0]  # n-grams that reach into the answer
        parts.append((n, np.unique(grams(found.hash[:cut], n) if cut >= n else found.hash[:0]), np.unique(grams(answer, n))))
    return ItemIndex(list(ids), vocab, seen, first, item, value, block_first, item[start] // block, block_max, essential, float(top[weak].sum()), parts, block, window)


def retrieve(index: ItemIndex, hashes: np.ndarray, doc: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, item number, best score) of all items that some passage retrieves."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    maybe = np.flatnonzero(index.seen[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
    if not len(maybe) or not len(index.vocab):
        return none
    term = np.minimum(np.searchsorted(index.vocab, hashes[maybe]), len(index.vocab) - 1)
    real = index.vocab[term] == hashes[maybe]
    term, maybe = term[real], maybe[real]
    half = index.window // 2
    step = position[maybe] // half
    # windows k and k-1 of a document hold the words of step k; window numbers start at 1
    most = int(position.max()) // half + 2 if len(position) else 2
    base = doc[maybe] * most + step
    passage = np.concatenate([base, base + 1])
    term = np.concatenate([term, term])
    key = np.unique(passage * len(index.vocab) + term)
    passage, term = key // len(index.vocab), key % len(index.vocab)
    strong = index.essential[term]
    entry, owner = expand(index.block_first, term[strong])
    blocks = len(index.items) // index.block + 1
    cell, inverse = np.unique(passage[strong][owner] * blocks + index.block_no[entry], return_inverse=True)
    bound = np.bincount(inverse, weights=index.block_max[entry], minlength=len(cell))
    open_cells = cell[bound + index.weak >= 1 - 1e-9]
    if not len(open_cells):
        return none
    open_passages = np.unique(open_cells // blocks)
    inside = np.isin(passage, open_passages)
    entry, owner = expand(index.first, term[inside])
    item = index.post_item[entry]
    home = passage[inside][owner]
    live = np.isin(home * blocks + item // index.block, open_cells)
    pair, inverse = np.unique(home[live] * len(index.items) + item[live], return_inverse=True)
    score = np.bincount(inverse, weights=index.post_value[entry][live], minlength=len(pair))
    pair, score = pair[score >= 1 - 1e-9], score[score >= 1 - 1e-9]
    where, best = np.unique(pair // len(index.items) // most * len(index.items) + pair % len(index.items), return_inverse=True)
    top = np.zeros(len(where))
    np.maximum.at(top, best, score)
    return where // len(index.items), where % len(index.items), top


def contained(part: np.ndarray, have: np.ndarray) -> float:
    """The share of ``part`` that occurs in sorted ``have`` (nothing to find: all of it)."""
    if not len(part):
        return 1.0
    at = np.minimum(np.searchsorted(have, part), max(0, len(have) - 1))
    return float((have[at] == part).mean()) if len(have) else 0.0


OUTPUT = "doc_id {0}, item_id {1}, bm25 double, question_overlap double, answer_overlap double"


def _shards(items: DataFrame, item_text: str, window: int, share: float, shard_bytes: int):
    """Broadcast indexes of the different item texts, one at a time; items are their texts' numbers ``text_key``."""
    spark = items.sparkSession
    slim = items.select(F.coalesce(F.col(item_text), F.lit("")).alias("text")).distinct().select(F.xxhash64("text").alias("text_key"), "text")
    bytes_ = F.sum(F.octet_length("text") + 16)
    total, n, largest = slim.agg(bytes_, F.count(F.lit(1)), F.max(F.octet_length("text") + 16)).first()
    shards = 1
    while (total or 0) > shard_bytes:  # more shards until the largest holds no more than the bound, or one text
        shards *= 2
        most = slim.groupBy(F.pmod(F.xxhash64("text_key"), F.lit(shards)).alias("shard")).agg(bytes_.alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.max("b")).first()[0]
        if (most or 0) <= max(shard_bytes, 0 if shards < n else total):
            break
    slim = slim.withColumn("shard", F.pmod(F.xxhash64("text_key"), F.lit(shards)).cast("int"))
    held = slim.select("shard", "text").mapInArrow(_item_words, "shard int, word bigint, n bigint")
    if shards > 1:
        held = materialise(held, "item-words")
    mean = (held.where("word is null").agg(F.avg("n")).first()[0]) or 0.0
    times = held.where("word is not null").groupBy("word").agg(F.count(F.lit(1)).alias("times"), F.collect_set("shard").alias("shards"))
    if shards > 1:
        times = materialise(times, "item-words")
    for shard in range(shards):
        bounded = slim.where(F.col("shard") == shard).orderBy("text_key").select("text_key", "text").collect()  # at most shard_bytes
        if not bounded and shards > 1:
            continue
        known = times.where(F.array_contains("shards", shard)).select("word", "times").toPandas()  # of this shard's words only
        vocab = known["word"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(vocab)
        stats = Statistics(n, float(mean), vocab[order], known["times"].to_numpy(np.int64)[order])
        yield spark.sparkContext.broadcast(build_index([r["text_key"] for r in bounded], [r["text"] for r in bounded], window, share, stats=stats))


def verified(index: ItemIndex, column: pa.Array, overlap: float) -> list[tuple]:
    """(row, item number, score, question overlap, answer overlap) of all matches in one slice of texts."""
    w = words(column)
    position = np.arange(len(w.hash)) - w.first[w.doc] if len(w.hash) else np.zeros(0, np.int64)
    doc, item, score = retrieve(index, w.hash, w.doc, position)
    kept = []
    for d in np.unique(doc):
        own = w.hash[w.first[d] : w.first[d + 1]]
        have = {}
        for j in np.flatnonzero(doc == d):
            n, *halves = index.parts[item[j]]
            if n not in have:
                have[n] = np.unique(grams(own, n)) if len(own) >= n else own[:0]
            q, a = (contained(x, have[n]) for x in halves)
            if q >= overlap and a >= overlap:
                kept.append((int(d), int(item[j]), round(float(score[j]), 6), round(q, 6), round(a, 6)))
    return kept


def matches(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", overlap: float = 0.5, window: int = 128, share: float = 0.6, shard_bytes: int = 4 << 20) -> DataFrame:
    """A row for each document and item that it contains: doc_id, item_id, bm25 (in item thresholds), question_overlap, answer_overlap.

    Repeated items give repeated rows, repeated document rows too.
    """
    own = docs.schema[doc_id].dataType.simpleString()
    schema = _parse_datatype_string(OUTPUT.format(own, "bigint"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = None
    for shared in _shards(items, item_text, window, share, shard_bytes):

        def run(batches, shared=shared):
            index, arrow = shared.value, to_arrow_schema(schema)
            for batch in batches:
                for part in slices(batch, "text", 1 << 20):
                    kept = verified(index, part.column(1), overlap)
                    ids = pa.array([index.items[k[1]] for k in kept], arrow.field("item_id").type)
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array([k[0] for k in kept], pa.int64())), ids, *[pa.array([k[c] for k in kept], pa.float64()) for c in (2, 3, 4)]], schema=arrow)

        part = rows.mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = rows.sparkSession.createDataFrame([], schema)
    names = items.select(F.xxhash64(F.coalesce(F.col(item_text), F.lit(""))).alias("text_key"), F.col(item_id).alias("item"))
    return found.withColumnRenamed("item_id", "text_key").join(names, "text_key").select("doc_id", F.col("item").alias("item_id"), "bm25", "question_overlap", "answer_overlap")


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text", overlap: float = 0.5, window: int = 128, share: float = 0.6, shard_bytes: int = 4 << 20) -> DataFrame:
    """The documents that contain none of the items, with all their columns; a narrow map for each shard of items."""
    for shared in _shards(items, item_text, window, share, shard_bytes):

        def run(batches, shared=shared):
            for batch in batches:
                for part in slices(batch, text, 1 << 20):
                    gone = {k[0] for k in verified(shared.value, part.column(part.schema.get_field_index(text)), overlap)}
                    yield part.take(pa.array([i for i in range(part.num_rows) if i not in gone], pa.int64()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
