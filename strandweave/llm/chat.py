"""Chat formatting with typed content parts.

A message is a role and a list of parts (text, image, audio, document).  A
visitor flattens the parts into one string: text is escaped, every other part
becomes a placeholder ``<kind:n>``, numbered through the conversation, and is
recorded as an attachment with its reference and the tokens it expands to.  Parts of
any other kind stand as ``<other:n>`` and are recorded, too, with their own kind and
no tokens; a part without a kind is text.

Template: ``<turn>`` role, line feed, content, ``</turn>``, line feed.  Inside
roles and texts a backslash precedes every backslash and ``<`` (and stands as
``\\n`` for a line feed in a role), so that no control string can occur there and
``read_chats`` gives the texts back exactly.  The loss mask covers the content of
assistant turns, as code point spans of the formatted string.

Rows are ordered by turn, ties by role and text, null turns first; null roles and
texts are empty; repeated rows stay; rows with a null conversation id form one
conversation.  Extra columns of the input rows are dropped by ``messages``.
"""

from __future__ import annotations

import math
import re
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StringType, _parse_datatype_string

from .common import with_arrow

PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
MESSAGES = f"array<struct<role:string,parts:array<{PART}>>>"
SPAN = "array<struct<start:bigint,stop:bigint>>"
ATTACHMENT = "array<struct<ordinal:int,turn:int,kind:string,ref:string,start:bigint,stop:bigint,tokens:bigint>>"
_TURN = re.compile(r"<turn>((?:[^\\<\n]|\\.)*)\n((?:[^\\<]|\\.|<(?:image|audio|document|other):\d+>)*)</turn>\n", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str, role: bool = False) -> str:
    text = text.replace("\\", "\\\\").replace("<", "\\<")
    return text.replace("\n", "\\n") if role else text


def unescape(text: str, role: bool = False) -> str:
    return _ESCAPED.sub(lambda m: "\n" if role and m[1] == "n" else m[1], text)


class Flattener:
    """Visits the parts of a conversation and writes the formatted string."""

    def __init__(self, patch: int = 14, audio_rate: float = 25.0, page_tokens: int = 512):
        self.patch, self.audio_rate, self.page_tokens = patch, audio_rate, page_tokens
        self.out: list[str] = []
        self.at = 0
        self.loss: list[dict] = []
        self.attachments: list[dict] = []

    def write(self, text: str) -> None:
        self.out.append(text)
        self.at += len(text)

    def tokens(self, part: dict) -> int:
        """Expanded tokens: patches of an image, frames of a sound, a fixed number for each page."""
        if part["kind"] == "image":
            return math.ceil((part["width"] or 0) / self.patch) * math.ceil((part["height"] or 0) / self.patch)
        if part["kind"] == "audio":
            return math.ceil((part["seconds"] or 0.0) * self.audio_rate)
        return (part["pages"] or 0) * self.page_tokens if part["kind"] == "document" else 0

    def visit_text(self, turn: int, part: dict) -> None:
        self.write(escape(part["text"] or ""))

    def visit_attachment(self, turn: int, part: dict) -> None:
        start, n = self.at, len(self.attachments)
        self.write(f"<{part['kind'] if part['kind'] in self.VISITS else 'other'}:{n}>")
        self.attachments.append({"ordinal": n, "turn": turn, "kind": part["kind"], "ref": part["ref"], "start": start, "stop": self.at, "tokens": self.tokens(part)})

    VISITS = {None: visit_text, "text": visit_text, "image": visit_attachment, "audio": visit_attachment, "document": visit_attachment}

    def visit(self, messages: list[dict]) -> str:
        for turn, message in enumerate(messages):
            self.write(f"<turn>{escape(message['role'] or '', True)}\n")
            start = self.at
            for part in message["parts"] or []:
                self.VISITS.get(part["kind"], Flattener.visit_attachment)(self, turn, part)
            if message["role"] == "assistant":
                self.loss.append({"start": start, "stop": self.at})
            self.write("</turn>\n")
        return "".join(self.out)


def _format(batch: pa.RecordBatch, column: str, settings: dict) -> list:
    formatted, loss, attachments = [], [], []
    for messages in batch.column(batch.schema.get_field_index(column)).to_pylist():
        flat = Flattener(**settings)
        formatted.append(flat.visit(messages or []))
        loss.append(flat.loss)
        attachments.append(flat.attachments)
    return [formatted, loss, attachments]


def _read(batch: pa.RecordBatch, formatted: str, loss: str) -> list:
    turns, learnt = [], []
    for text, spans in zip(batch.column(batch.schema.get_field_index(formatted)).to_pylist(), batch.column(batch.schema.get_field_index(loss)).to_pylist(), strict=True):
        turns.append([{"role": unescape(m[1], True), "text": unescape(m[2])} for m in _TURN.finditer(text or "")])
        learnt.append([unescape(text[s["start"] : s["stop"]]) for s in spans or []])
    return [turns, learnt]


def messages(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation, its turns in order, each with one text part."""
    rows = F.sort_array(F.collect_list(F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))))
    one = lambda m: F.struct(m["role"].alias("role"), F.array(F.struct(F.lit("text").alias("kind"), m["text"].alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"), F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages"))).alias("parts"))
    return df.groupBy(F.col(conversation).alias("conv_id")).agg(F.transform(rows, one).alias("messages"))


def format_chats(df: DataFrame, column: str = "messages", patch: int = 14, audio_rate: float = 25.0, page_tokens: int = 512) -> DataFrame:
    """Appends ``formatted``, ``loss_spans`` and ``attachments`` to rows with a ``messages`` column of type MESSAGES."""
    fields = [StructField("formatted", StringType()), StructField("loss_spans", _parse_datatype_string(SPAN)), StructField("attachments", _parse_datatype_string(ATTACHMENT))]
    return with_arrow(df, fields, partial(_format, column=column, settings={"patch": patch, "audio_rate": audio_rate, "page_tokens": page_tokens}))


def read_chats(df: DataFrame, formatted: str = "formatted", loss: str = "loss_spans") -> DataFrame:
    """Appends ``turns`` and ``loss_texts``, read back from the formatted strings (placeholders stay in the texts)."""
    fields = [StructField("turns", _parse_datatype_string("array<struct<role:string,text:string>>")), StructField("loss_texts", ArrayType(StringType()))]
    return with_arrow(df, fields, partial(_read, formatted=formatted, loss=loss))
