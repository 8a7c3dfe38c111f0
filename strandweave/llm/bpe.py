"""Byte-level BPE encoding and decoding by a local rank file.

``bpe_encode`` appends the ids of every text, ``bpe_decode`` the bytes of every
id list.  Both are narrow maps: no shuffle, and memory is bounded by a slice of
rows.  Ids are stored as packed little-endian unsigned 32-bit integers.

Texts longer than ``span`` characters are cut at safe boundaries first, so that
the pattern never runs over an unbounded string: a cut before a single space
that stands between two characters that aren't white space can't lie inside a
match, because a match has white space only at its start or consists of it.

Null text counts as empty, an empty text has no ids; ties and repeated rows are
encoded alike; an input column named like an output column is replaced.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StructField

from .common import with_arrow

_SAFE = re.compile(r"(?<=\S) (?=\S)")


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_parts(text: str, span: int):
    """Cuts a text into parts of about ``span`` characters whose encodings join to that of the text."""
    at = 0
    while len(text) - at > span:
        cut = _SAFE.search(text, at + span)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def encode_text(text: str, enc, span: int) -> np.ndarray:
    if len(text) <= span:
        return np.array(enc.encode_ordinary(text), dtype="<u4")
    return np.concatenate([np.array(enc.encode_ordinary(p), dtype="<u4") for p in safe_parts(text, span)])


def _encode(batch: pa.RecordBatch, column: str, path: str, pattern: str, span: int) -> list:
    enc = encoding(path, pattern)
    texts = batch.column(batch.schema.get_field_index(column)).to_pylist()
    return [[encode_text(t or "", enc, span).tobytes() for t in texts]]


def _decode(batch: pa.RecordBatch, column: str, path: str, pattern: str) -> list:
    enc = encoding(path, pattern)
    packed = batch.column(batch.schema.get_field_index(column)).to_pylist()
    return [[enc.decode_bytes(np.frombuffer(x or b"", dtype="<u4").tolist()) for x in packed]]


def bpe_encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", span: int = 1 << 16) -> DataFrame:
    """Appends binary ``ids``: each match of ``pattern`` encoded separately by the ranks at ``path``, without special tokens."""
    return with_arrow(df, [StructField(ids, BinaryType())], partial(_encode, column=text, path=path, pattern=pattern, span=span), text)


def bpe_decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Appends the bytes that packed ``ids`` stand for (null: none)."""
    return with_arrow(df, [StructField(out, BinaryType())], partial(_decode, column=ids, path=path, pattern=pattern), ids)
