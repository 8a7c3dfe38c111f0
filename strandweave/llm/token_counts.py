"""Token counts with a digest cache.

A count is stored under the digest of the text and the digest of the tokenizer
file.  ``count_tokens`` looks all texts up by digest, encodes each distinct miss
once, appends the new counts to the cache and joins them back.  Copies are
merged before the shuffle (a partial aggregate per task), so a text that fills a
third of the rows reaches its reducer once per task.

Normalisation only turns null into the empty text: anything more could change a
count.  Repeated rows stay; extra columns stay; an input column named like an
output column is replaced.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, materialise, shared_path
from .scan import slices

CACHE_SCHEMA = "text_digest string, tokenizer_digest string, n_tokens bigint"
_MARK = "▁"


def file_digest(path: str) -> str:
    with open(path, "rb") as file:
        return hashlib.file_digest(file, "sha256").hexdigest()


class PieceCounter:
    """Counts of a SentencePiece model.

    BPE merges neighbours only where the joint piece is in the vocabulary.  If
    no piece has the space mark behind another character, no merge crosses a
    single space, and the count of a text is the sum over its words, which are
    remembered (at most ``most`` of them).  Texts with other spacing, and other
    models, are encoded whole.
    """

    def __init__(self, path: str, most: int = 1 << 19):
        import sentencepiece

        self.model, self.most, self.known = sentencepiece.SentencePieceProcessor(model_file=path), most, {}
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        crossing = any(_MARK in p[1:] and p.strip(_MARK) for p in pieces)
        same = all(self.model.normalize(x) == _MARK + x.replace(" ", _MARK) for x in ("a  b ", "A ééﬁ\n\tx", "　Ａ"))
        self.by_word = not crossing and same

    def counts(self, texts: list[str]) -> list[int]:
        known, out, whole, new = self.known, [0] * len(texts), [], {}
        if len(known) > self.most:
            known.clear()
        split: list[list[str] | None] = []
        for i, text in enumerate(texts):
            words = text.split(" ") if self.by_word and text and _MARK not in text else None
            if words is not None and "" in words:
                words = None
            split.append(words)
            if words is None:
                whole.append(i)
            else:
                new.update(dict.fromkeys(w for w in words if w not in known))
        if new:
            fresh = list(new)
            known.update(zip(fresh, map(len, self.model.encode(fresh, num_threads=1)), strict=True))
        for i, words in enumerate(split):
            if words is not None:
                out[i] = sum(map(known.__getitem__, words))
        for i, ids in zip(whole, self.model.encode([texts[i] for i in whole], num_threads=1) if whole else [], strict=True):
            out[i] = len(ids)
        return out


class VocabularyCounter:
    """Counts of a tokenizers file, without added special tokens, truncation or padding."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()

    def counts(self, texts: list[str]) -> list[int]:
        return [len(x.ids) for x in self.model.encode_batch(texts, add_special_tokens=False)]


@lru_cache(maxsize=2)
def counter(path: str):
    return PieceCounter(path) if re.search(r"\.model$", path) else VocabularyCounter(path)


def _encode_misses(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                counts = counter(path).counts(part.column(part.schema.get_field_index("text")).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("text_digest")), pa.array(counts, pa.int64())], names=["text_digest", "n_tokens"])

    return run


def read_cache(spark: SparkSession, cache: str, tokenizer_digest: str) -> DataFrame | None:
    """The stored counts of one tokenizer, or None where nothing has been stored."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(cache)
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return None
    return spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("tokenizer_digest") == tokenizer_digest).select("text_digest", "n_tokens").groupBy("text_digest").agg(F.min("n_tokens").alias("n_tokens"))


def count_tokens(df: DataFrame, tokenizer: str, cache: str | None = None, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """Appends the token count of every whole text.

    ``tokenizer`` is a .model (SentencePiece) or .json (tokenizers) file that
    every executor can read; ``cache`` a folder of earlier counts, which grows by
    the new ones (default: a new folder under ``spark.checkpoint.dir``).
    """
    spark = df.sparkSession
    cache = cache or shared_path(spark, "token-counts")
    version = file_digest(tokenizer)
    clean = F.coalesce(F.col(text), F.lit(""))
    texts = df.select(F.sha2(clean, 256).alias("text_digest"), clean.alias("text"))
    stored = read_cache(spark, cache, version)
    if stored is not None:  # find the misses by digest alone before any text is shuffled
        texts = texts.join(texts.select("text_digest").distinct().join(stored, "text_digest", "left_anti"), "text_digest", "left_semi")
    misses = texts.groupBy("text_digest").agg(F.first("text").alias("text"))
    misses.mapInArrow(_encode_misses(tokenizer), "text_digest string, n_tokens bigint").select("text_digest", F.lit(version).alias("tokenizer_digest"), "n_tokens").write.mode("append").parquet(cache)
    digest, count = fresh(df, "digest_key", "count_key")
    # written once, so that both sides of the join are plain exchanges, whose hot digests can be split
    counts = materialise(read_cache(spark, cache, version), "token-counts-once").select(F.col("text_digest").alias(digest), F.col("n_tokens").alias(count))
    keep = [c for c in df.columns if c != out]
    return df.withColumn(digest, F.sha2(clean, 256)).join(counts, digest, "left").select(*keep, F.col(count).alias(out))
