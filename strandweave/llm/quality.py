"""Quality classifier: Bradley-Terry ranking learnt from preference pairs.

Every pair of a good and a bad labelled document is a preference; document
scores are linear in text features, and the weights minimise the logistic loss
on feature differences.  The cut is a quantile of the training scores (the one
with the best training accuracy); scores are reported as the logistic of the
distance from it, so 0.5 is the cut.

Features come from the text alone, by vectorised byte and word statistics; no
Python code runs per word.  Fitting collects the features of at most ``sample``
labelled documents, chosen by hash; scoring is a narrow map.

Null text counts as empty; an empty text gets the score of its (zero) features.
Without labels of both kinds nothing can be learnt: all scores are 0.5, which
keeps every document.  Of contradicting labels the lower one counts.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, _parse_datatype_string

from .common import with_arrow
from .scan import text_buffer, words

FEATURES = ("upper", "marks", "shouts", "bars", "digits", "other", "same_next", "distinct", "top_word", "word_bytes", "log_bytes", "words_per_line")
_CLASS = np.full(256, 5, np.uint8)
_CLASS[[*range(97, 123), *range(128, 256)]] = 6
_CLASS[[9, 10, 13, 32, 44, 46]] = 7
_CLASS[65:91] = 0
_CLASS[[ord(c) for c in "#$%&*@^~<>{}[]=_\\/+"]] = 1
_CLASS[ord("!")] = 2
_CLASS[ord("|")] = 3
_CLASS[48:58] = 4


def text_features(column: pa.Array) -> np.ndarray:
    """A row of FEATURES for each text."""
    data, offsets = text_buffer(column)
    n, size = len(offsets) - 1, np.diff(offsets).astype(np.float64)
    out = np.zeros((n, len(FEATURES)))
    if not n:
        return out
    kind = _CLASS[data]
    counts = np.stack([np.diff(np.r_[0, np.cumsum(kind == k, dtype=np.int64)][offsets]) for k in range(6)], axis=1)
    solid = np.maximum(1, size - np.diff(np.r_[0, np.cumsum(kind == 7, dtype=np.int64)][offsets]))
    ratio = counts / solid[:, None]
    out[:, :6] = np.minimum(1, ratio * np.array([2, 20, 20, 20, 10, 10]))
    w = words(column)
    total = np.diff(w.first).astype(np.float64)
    some = np.maximum(1, total)
    twin = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
    out[:, 6] = np.minimum(1, 5 * np.bincount(w.doc[1:][twin], minlength=n) / np.maximum(20, total))
    key = np.sort((w.doc.astype(np.uint64) << np.uint64(40)) | (w.hash >> np.uint64(24)))
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    run = np.diff(np.r_[start, len(key)])
    owner = (key[start] >> np.uint64(40)).astype(np.int64)
    # distinct words against what a text of this length usually has
    out[:, 7] = np.minimum(1, np.bincount(owner, minlength=n) / np.maximum(1, some**0.8))
    top = np.zeros(n)
    np.maximum.at(top, owner, run)
    out[:, 8] = top / some * np.minimum(1, total / 20)
    out[:, 9] = np.minimum(2, np.bincount(w.doc, weights=w.end - w.start, minlength=n) / some / 6)
    out[:, 10] = np.log1p(size) / 10
    lines = np.diff(np.r_[0, np.cumsum(data == 10, dtype=np.int64)][offsets]) + 1
    out[:, 11] = np.minimum(1, total / lines / 100)
    return out


@dataclass
class Ranker:
    """weights over standardised features; score = logistic(sharpness * (w.x - cut))."""

    mean: np.ndarray = field(default_factory=lambda: np.zeros(len(FEATURES)))
    scale: np.ndarray = field(default_factory=lambda: np.ones(len(FEATURES)))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(FEATURES)))
    cut: float = 0.0
    sharpness: float = 1.0

    def worth(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.sharpness * (self.worth(x) - self.cut), -500, 500)))


def fit_pairs(x: np.ndarray, label: np.ndarray, pairs: int = 40_000, rounds: int = 25, ridge: float = 1e-3, seed: int = 7) -> Ranker:
    """Newton steps on the Bradley-Terry loss of ``pairs`` drawn (good, bad) preferences."""
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        return Ranker()
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1.0
    z = (x - mean) / scale
    draw = np.random.default_rng(seed)
    d = z[draw.choice(good, pairs)] - z[draw.choice(bad, pairs)]
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))  # chance given to the wrong order
        gradient = d.T @ p / pairs - ridge * w
        hessian = (d * (p * (1 - p))[:, None]).T @ d / pairs + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    model = Ranker(mean, scale, w)
    s = model.worth(x)
    cuts = np.unique(np.quantile(s, np.linspace(0, 1, 401)))
    cuts = (cuts[1:] + cuts[:-1]) / 2 if len(cuts) > 1 else cuts
    order = np.sort(s[good]), np.sort(s[bad])
    right = (len(good) - np.searchsorted(order[0], cuts, "left")) + np.searchsorted(order[1], cuts, "left")
    best = np.flatnonzero(right == right.max())
    model.cut = float(cuts[best[len(best) // 2]])
    return model


def _features(batch: pa.RecordBatch, column: str) -> list:
    x = text_features(batch.column(batch.schema.get_field_index(column)))
    flat = pa.array(x.ravel())
    return [pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), flat)]


def _score(batch: pa.RecordBatch, column: str, model: Ranker) -> list:
    return [pa.array(model.score(text_features(batch.column(batch.schema.get_field_index(column)))))]


def may_learn(doc_id: Column) -> Column:
    """Rows whose labels may be used: the CRC-32 of the id, modulo 3, isn't 1."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3) != 1


def fit_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = 20_000) -> Ranker:
    """Learns from ``labels`` (doc_id, quality) of at most ``sample`` documents outside the held-out third."""
    chosen = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & may_learn(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id")  # at most `sample` rows are broadcast
    found = with_arrow(rows, [StructField("features", _parse_datatype_string("array<double>"))], partial(_features, column="text"), "text").select("doc_id", "quality", "features").collect()
    found = list({r["doc_id"]: r for r in sorted(found, key=lambda r: (r["doc_id"], r["features"]))}.values())
    if not found:
        return Ranker()
    return fit_pairs(np.array([r["features"] for r in found]), np.array([r["quality"] for r in found]))


def score_quality(df: DataFrame, model: Ranker, text: str = "text", out: str = "score") -> DataFrame:
    """Appends the score (0 to 1, higher: better) of every whole text."""
    return with_arrow(df, [StructField(out, DoubleType())], partial(_score, column=text, model=model), text)
