"""Pattern matches with code point positions, by SQL functions only.

``split`` and ``regexp_extract_all`` give what lies between the matches and the
matches themselves; running lengths give their places, for blocks of matches first
and within each block then, so that collecting them copies short arrays only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

BLOCK = 64

MATCH = "struct<s:bigint,e:bigint,m:string,l:string,r:string>"
NONE = f"CAST(array() AS array<{MATCH}>)"


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def with_matches(df: DataFrame, text: Column, patterns: dict[str, tuple[str, str]], out: str, left: int = 32, right: int = 16) -> DataFrame:
    """Appends a struct ``out`` with an array of MATCH for each name: start, end (exclusive), match, and what stands before and behind it.

    ``patterns`` maps names to (pattern, guard); the guard is a cheap SQL condition
    on ``{0}`` without which there can be no match.
    """
    kept = list(df.columns)
    clean, hits, between = fresh(df, "clean_text", "hits_", "between_")
    df = df.withColumn(clean, F.coalesce(text, F.lit("")))
    found = [F.when(F.expr(guard.format(f"`{clean}`")), F.regexp_extract_all(clean, F.lit(pattern), F.lit(0))).alias(name) for name, (pattern, guard) in patterns.items()]
    df = df.withColumn(hits, F.struct(*found))
    df = df.withColumn(between, F.struct(*[F.when(F.size(f"{hits}.{name}") > 0, F.split(clean, pattern, -1)).alias(name) for name, (pattern, _) in patterns.items()]))
    return df.select(*kept, F.struct(*[F.expr(_places(f"`{between}`.{name}", f"`{hits}`.{name}", left, right)).alias(name) for name in patterns]).alias(out))


def _places(p: str, h: str, left: int, right: int) -> str:
    # blocks of matches with their widths, then the blocks' places, then the places within each block
    blocks = f"transform(sequence(0, (size({h}) - 1) div {BLOCK}), i -> zip_with(zip_with(slice({p}, i * {BLOCK} + 1, {BLOCK}), slice({h}, i * {BLOCK} + 1, {BLOCK}), (p, h) -> named_struct('p', p, 'h', h)), slice({p}, i * {BLOCK} + 2, {BLOCK}), (x, n) -> named_struct('p', x.p, 'h', x.h, 'n', n)))"
    width = "aggregate(b, 0L, (a, x) -> a + length(x.p) + coalesce(length(x.h), 0))"
    placed = f"aggregate(transform({blocks}, b -> named_struct('b', b, 'w', {width})), named_struct('at', 0L, 'out', CAST(array() AS array<struct<at:bigint,b:array<struct<p:string,h:string,n:string>>>>)), (a, x) -> named_struct('at', a.at + x.w, 'out', array_append(a.out, named_struct('at', a.at, 'b', x.b))), a -> a.out)"
    step = f"named_struct('at', a.at + length(x.p) + length(x.h), 'out', array_append(a.out, named_struct('s', a.at + length(x.p), 'e', a.at + length(x.p) + length(x.h), 'm', x.h, 'l', right(x.p, {left}), 'r', left(x.n, {right}))))"
    inside = f"aggregate(o.b, named_struct('at', o.at, 'out', {NONE}), (a, x) -> CASE WHEN x.h IS NULL THEN a ELSE {step} END, a -> a.out)"
    return f"CASE WHEN size({h}) > 0 THEN flatten(transform({placed}, o -> {inside})) ELSE {NONE} END"
