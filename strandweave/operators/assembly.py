"""Read overlap assembly, colour consensus, edit scripts.

Assembly works on one region at a time through ``applyInPandas``, whose reads are
few; edit scripts on one sequence.  The consensus and the windows of edits run over
blocks of places.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..lineage import cut
from .intervals import running

BASES = "ACGT"


def overlap(a: str, b: str, least: int) -> int:
    """The longest suffix of ``a`` that starts ``b``, at least ``least`` long; 0 if there is none or b lies within a."""
    for n in range(min(len(a), len(b)) - (a == b), least - 1, -1):
        if a.endswith(b[:n]):
            return n
    return 0


def longest_shortest_path(edges: dict[int, list[tuple[int, int]]], starts: list[int], ends: set[int]) -> list[int]:
    """Of the paths with the fewest steps from a start to each end, the one with the most; ties go to the lower nodes."""
    best: list[int] = []
    for s in sorted(starts):
        parent, layer, seen = {s: None}, [s], {s}
        while layer:
            following = []
            for u in layer:
                for v, _ in sorted(edges.get(u, [])):
                    if v not in seen:
                        seen.add(v)
                        parent[v] = u
                        following.append(v)
            layer = following
        for e in sorted(ends & seen):
            path, at = [], e
            while at is not None:
                path.append(at)
                at = parent[at]
            if len(path) > len(best):
                best = path[::-1]
    return best


def assemble(reads: list[str], least: int) -> str:
    """The sequence along the longest shortest path of the overlap graph, from reads without a predecessor to reads without a successor."""
    reads = sorted(set(reads))
    edges = {i: [(j, n) for j, b in enumerate(reads) if i != j and (n := overlap(a, b, least))] for i, a in enumerate(reads)}
    entered = {j for out in edges.values() for j, _ in out}
    starts = [i for i in edges if i not in entered] or list(edges)[:1]
    ends = {i for i, out in edges.items() if not out} or set(edges)
    path = longest_shortest_path(edges, starts, ends)
    text = reads[path[0]] if path else ""
    for u, v in zip(path[:-1], path[1:], strict=True):
        text += reads[v][dict(edges[u])[v] :]
    return text


def assemble_regions(reads: DataFrame, least: int = 10) -> DataFrame:
    """(region, sequence, n_reads) of reads (region, seq)."""
    kind = reads.schema["region"].dataType.simpleString()

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"region": frame["region"].iloc[:1], "sequence": [assemble(frame["seq"].tolist(), least)], "n_reads": [len(frame)]})

    return reads.select("region", "seq").groupBy("region").applyInPandas(one, f"region {kind}, sequence string, n_reads bigint")


def consensus(length: int, placed: list[tuple[int, str]], first: str | None = None) -> str:
    """Bases of a contig from colour reads at 0-based places: the cheapest path over four states a column.

    Going from base a to b costs the number of reads whose colour there differs from
    theirs; columns that no read covers are N.
    """
    votes = np.zeros((max(0, length - 1), 4), np.int64)
    for at, colors in placed:
        for i, c in enumerate(colors):
            if c in "0123" and 0 <= at + i < length - 1:
                votes[at + i, int(c)] += 1
    covered = votes.sum(axis=1) > 0
    cost = np.zeros(4) if first is None else np.where(np.arange(4) == BASES.index(first), 0, 1 << 30).astype(float)
    move = np.bitwise_xor.outer(np.arange(4), np.arange(4))
    back = np.zeros((len(votes), 4), np.int64)
    for i, v in enumerate(votes):
        step = cost[:, None] + (v.sum() - v)[move] if covered[i] else np.repeat(cost[:, None], 4, axis=1)
        back[i] = np.argmin(step, axis=0)
        cost = step.min(axis=0)
    state = int(np.argmin(cost))
    out = [state]
    for i in range(len(votes) - 1, -1, -1):
        state = int(back[i, state])
        out.append(state)
    known = np.r_[covered, False] | np.r_[False, covered] if length > 1 else np.zeros(length, bool)
    return "".join(BASES[s] if k else "N" for s, k in zip(out[::-1], known, strict=True)) if length else ""


def _blocks(rows: DataFrame, chunk: int) -> DataFrame:
    """(contig, chunk_start, pos, colors): the part of each read in every chunk of places that it touches."""
    spans = rows.where(F.length("colors") > 0).select("contig", F.col("pos").cast("bigint").alias("pos"), "colors", F.length("colors").alias("_n"))
    first, last = F.floor(F.col("pos") / chunk), F.floor((F.col("pos") + F.col("_n") - 1) / chunk)
    cut_ = spans.withColumn("chunk_start", F.explode(F.transform(F.sequence(first, last), lambda i: i * chunk))).where("chunk_start >= 0")
    skip = F.greatest(F.col("chunk_start") - F.col("pos"), F.lit(0)).cast("int")
    whole = (F.col("pos") >= F.col("chunk_start")) & (F.col("pos") + F.col("_n") <= F.col("chunk_start") + chunk)
    at = F.col("pos") + skip
    part = F.when(whole, F.col("colors")).otherwise(F.substring(F.col("colors"), skip + 1, (F.col("chunk_start") + chunk - at).cast("int")))
    return cut_.select("contig", "chunk_start", (at - F.col("chunk_start")).cast("int").alias("at"), part.alias("colors"))


def _voted(batches, schema: pa.Schema):
    """Each chunk's most frequent colours (``.`` where no read votes) and their exclusive or, from its reads in order of (contig, chunk_start)."""
    rest = None
    for batch in itertools.chain(batches, [None]):
        table = pa.Table.from_batches([*(rest.to_batches() if rest is not None else []), *([batch] if batch is not None else [])]) if rest is not None or batch is not None else None
        if table is None or not table.num_rows:
            continue
        new = pc.or_(pc.not_equal(table["contig"][1:], table["contig"][:-1]), pc.not_equal(table["chunk_start"][1:], table["chunk_start"][:-1])).to_numpy()
        start = np.r_[0, np.flatnonzero(new) + 1]
        if batch is not None:  # the last chunk may go on
            rest = table.slice(start[-1])
            table, start = table.slice(0, start[-1]), start[:-1]
            if not table.num_rows:
                continue
        text = table["colors"].combine_chunks().cast(pa.large_binary())
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        data = np.frombuffer(text.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        size, at = np.diff(offsets), table["at"].to_numpy().astype(np.int64)
        group = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(at)]))
        width = np.maximum.reduceat(at + size, start)
        ends = np.r_[0, np.cumsum(width)]
        place = np.arange(len(data)) + np.repeat(ends[group] + at - (offsets[:-1] - offsets[0]), size)
        code = data.astype(np.int64) - 48
        ok = (code >= 0) & (code < 4)
        votes = np.bincount(place[ok] * 4 + code[ok], minlength=4 * ends[-1]).reshape(-1, 4)
        best = votes.argmax(axis=1).astype(np.uint8)  # ties: the lowest
        colors = np.where(votes.any(axis=1), best + 48, 46).astype(np.uint8)
        held = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(colors))
        rows = table.select(["contig", "chunk_start"]).take(pa.array(start))
        total = np.bitwise_xor.reduceat(best, ends[:-1]).astype(np.int32)  # uncovered places count as colour 0
        last = (width > 0) & (colors[ends[1:] - 1] != 46)
        columns = [rows["contig"].combine_chunks(), rows["chunk_start"].combine_chunks(), held, pa.array(width, pa.int32()), pa.array(total), pa.array(last)]
        yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _decoded(colors: pd.Series, code: pd.Series, known: pd.Series, wide: pd.Series) -> pd.Series:
    """Bases of chunks from their colours, the code of their first base, whether the place in front of it is covered, and their length."""
    letters, out = np.frombuffer(BASES.encode(), np.uint8), []
    for text, c, k, n in zip(colors, code, known, wide, strict=True):
        raw = np.full(n, 46, np.uint8)
        given = np.frombuffer((text or "").encode(), np.uint8)[:n]
        raw[: len(given)] = given
        covered = raw != 46
        bases = np.full(n, c, np.uint8)
        bases[1:] ^= np.bitwise_xor.accumulate(np.where(covered, raw - 48, 0).astype(np.uint8))[:-1]
        seen = covered | np.r_[k, covered[:-1]]
        out.append(np.where(seen, letters[bases], 78).astype(np.uint8).tobytes().decode())
    return pd.Series(out, dtype=object)


def consensus_contigs(rows: DataFrame, chunk: int = 1 << 12) -> DataFrame:
    """(contig, chunk_start, seq), ``consensus`` of placed reads (contig, length, pos, colors) in chunks; minus-strand colours must be reversed already.

    Each pair of bases has one colour, so the cheapest path takes each column's most
    frequent colour on its own (ties: the lowest), and a base is the exclusive or of all
    colours in front.  Reads are dealt to chunks of places, where their votes are counted;
    chunks carry their exclusive or on, a short row each.  No task holds a contig.  Paths
    start from ``first`` if the rows have such a column, from A otherwise (all four
    starts cost the same), and go on over uncovered columns as over colour 0.  Bases
    beside no covered column are N.
    """
    start = F.min("first") if "first" in rows.columns else F.lit("A")
    contigs = rows.groupBy("contig").agg(F.max("length").cast("bigint").alias("length"), F.coalesce(start, F.lit("A")).alias("first")).where("length > 0")
    kind = rows.schema["contig"].dataType.simpleString()
    schema = f"contig {kind}, chunk_start bigint, colors string, n int, total int, covered boolean"
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    dealt = _blocks(rows, chunk).repartition("contig", "chunk_start").sortWithinPartitions("contig", "chunk_start")
    voted = cut(dealt.mapInArrow(lambda x: _voted(x, arrow), schema))
    every = contigs.select("contig", "length", "first", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(chunk).cast("bigint"))).alias("chunk_start"))
    short = every.join(voted.drop("colors"), ["contig", "chunk_start"], "left")
    by = Window.partitionBy("contig").orderBy("chunk_start")  # a short row for each chunk
    before, front = by.rowsBetween(Window.unboundedPreceding, -1), F.lag(F.when(F.col("n") == chunk, F.col("covered"))).over(by)
    code = F.coalesce(F.bit_xor("total").over(before), F.lit(0)).bitwiseXOR(F.instr(F.lit(BASES), F.col("first")) - 1)
    wide = F.least(F.col("length") - F.col("chunk_start"), F.lit(chunk)).cast("int")
    short = short.select("contig", "chunk_start", "length", code.alias("code"), F.coalesce(front, F.lit(False)).alias("known"), wide.alias("wide"))
    held = short.join(voted.select("contig", "chunk_start", "colors"), ["contig", "chunk_start"], "left")
    # the last place that counts is the one in front of the last base
    colors = F.left("colors", (F.col("length") - 1 - F.col("chunk_start")).cast("int"))
    return held.select("contig", "chunk_start", F.pandas_udf(_decoded, "string")(colors, "code", "known", "wide").alias("seq"))


def apply_edits(seq: str, edits: list[tuple[int, str, str]]) -> str:
    """A sequence after edits (0-based place, kind, text): R replaces as many letters, I inserts in front, D deletes as many letters as its text has.  Places are of the unedited sequence."""
    out, at = [], 0
    for place, kind, text in sorted(edits):
        if place < at:
            raise ValueError(f"edits overlap at {place}")
        out.append(seq[at:place])
        out.append(text if kind in "RI" else "")
        at = place + (len(text) if kind in "RD" else 0)
    return "".join(out) + seq[at:]


def edit_contigs(sequences: DataFrame, edits: DataFrame) -> DataFrame:
    """(contig, seq) after the edits (contig, place, kind, text) of each contig."""
    left, right = sequences.select("contig", "seq").groupBy("contig"), edits.select("contig", "place", "kind", "text").groupBy("contig")
    kind = sequences.schema["contig"].dataType.simpleString()

    def one(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        changes = list(zip(b["place"].tolist(), b["kind"].tolist(), b["text"].tolist(), strict=True))
        return pd.DataFrame({"contig": a["contig"], "seq": [apply_edits(s, changes) for s in a["seq"]]})

    return left.cogroup(right).applyInPandas(one, f"contig {kind}, seq string")


def edit_windows(edits: DataFrame, flank: int = 5) -> DataFrame:
    """The edits (contig, place, kind, text) with the window of ``flank`` on both sides of their place in the edited sequence: start0, end0."""
    size = F.length("text").cast("bigint")
    change = F.when(F.col("kind") == "I", size).when(F.col("kind") == "D", -size).otherwise(F.lit(0).cast("bigint"))
    rows = running(edits.withColumn("_change", change), ["contig"], "place", {"_shift": ("_change", "sum")}, order=["kind", "text"], before=True)
    at = F.col("place") + F.col("_shift")
    return rows.select(*edits.columns, (at - flank).alias("start0"), (at + flank).alias("end0"))
