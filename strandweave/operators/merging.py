"""Merging of hit tables with reads and with each other, and small panel operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..lineage import cut
from .intervals import interval_join, numbered, running


def union(parts: Sequence[DataFrame]) -> DataFrame:
    """Outputs of several parts as one table."""
    return reduce(DataFrame.unionByName, parts)


def attach_reads(hits: DataFrame, reads: DataFrame, keep_all: bool = False, key: str = "read_id") -> DataFrame:
    """Hits with the columns of their reads; ``keep_all`` also returns reads without hits."""
    return hits.join(reads, key, "right" if keep_all else "inner")


def merge_hits(parts: Sequence[DataFrame], reads: DataFrame, mode: str = "all", key: str = "read_id") -> DataFrame:
    """A row per read with all hits of all parts, in order of mismatches, contig and position.

    ``mode``: ``all`` reads, only those that are ``hit``, or only those ``missed``.
    """
    per = union(parts).groupBy(key).agg(F.sort_array(F.collect_list(F.struct("mm", "contig", "pos0", "strand"))).alias("hits"))
    if mode == "missed":
        return reads.join(per.select(key), key, "left_anti")
    return reads.join(per, key, "inner" if mode == "hit" else "left")


def by_barcode(left: DataFrame, right: DataFrame, key: str = "bead_id") -> DataFrame:
    """Pairs of both tags of a bead; beads with one tag only are left out."""
    return left.join(right, key)


def merge_tags(r: DataFrame, f: DataFrame, key: str = "bead_id") -> DataFrame:
    """All beads of either tag, with ``side``: both, r_only or f_only."""
    both = r.withColumn("_r", F.lit(1)).join(f.withColumn("_f", F.lit(1)), key, "full")
    return both.withColumn("side", F.when(F.col("_f").isNull(), "r_only").when(F.col("_r").isNull(), "f_only").otherwise("both")).drop("_r", "_f")


def reuse(fresh: DataFrame, earlier: DataFrame, key: str = "bead_id") -> DataFrame:
    """Earlier results where there are any, fresh ones for the other beads."""
    return earlier.unionByName(fresh.join(earlier.select(key).distinct(), key, "left_anti"))


def near_regions(hits: DataFrame, regions: DataFrame, low: int, high: int) -> DataFrame:
    """Unpaired hits (contig, strand, pos) whose mate, ``low`` to ``high`` further on, could lie in a region (contig, start0, end0)."""
    minus = F.col("strand") == "-"
    spans = hits.withColumn("_s", F.when(minus, F.col("pos") - high).otherwise(F.col("pos") + low)).withColumn("_e", F.when(minus, F.col("pos") - low).otherwise(F.col("pos") + high))
    right = regions.select("contig", F.col("start0").alias("_rs"), F.col("end0").alias("_re"))
    return interval_join(spans, right, ["contig"], ("_s", "_e", "_rs", "_re"), how="left_semi").drop("_s", "_e")


def locate(offsets: DataFrame, contigs: DataFrame) -> DataFrame:
    """Contig and position of offsets into the concatenation of all contigs (contig_idx, length), in order of the index.

    A contig of 2^k to 2^(k + 1) - 1 bases is listed under the bins of 2^k bases that it
    touches, three at most, and a bin of its k holds two such contigs at most.  So an
    offset meets few contigs, however short or long they are; it looks in a bin of every
    k that occurs.
    """
    ends = running(contigs.select("contig_idx", "length"), [], "contig_idx", {"_end": ("length", "sum")}).where("length > 0")
    level = lambda c: F.length(F.bin(c)) - 1
    spans = cut(ends.select("contig_idx", (F.col("_end") - F.col("length")).alias("_start"), F.col("_end"), level(F.col("length")).alias("_level")))
    found = sorted(r["_level"] for r in spans.select("_level").distinct().collect())  # 63 at most
    bins = F.explode(F.expr("sequence(shiftright(_start, _level), shiftright(_end - 1, _level))"))
    points = offsets.withColumn("_level", F.explode(F.array(*map(F.lit, found)) if found else F.expr("CAST(array() AS array<int>)"))).withColumn("_bin", F.expr("shiftright(CAST(offset AS bigint), _level)"))
    rows = points.join(spans.withColumn("_bin", bins), ["_level", "_bin"]).where((F.col("offset") >= F.col("_start")) & (F.col("offset") < F.col("_end")))
    return rows.select(*offsets.columns, "contig_idx", (F.col("offset") - F.col("_start")).alias("pos0"))


def junction_by_number(hits: DataFrame, junctions: DataFrame) -> DataFrame:
    return hits.join(junctions, "junction_no")


def dicolor_counts(reads: DataFrame, column: str = "colors", pseudo: int = 1) -> DataFrame:
    """(pair, n): distinct reads that hold each pair of neighbouring colours, plus a pseudocount; pairs that never occur stay."""
    pairs = F.array(*[F.lit(f"{a}{b}") for a in range(4) for b in range(4)])
    seen = reads.select(F.explode(F.filter(pairs, lambda p: F.contains(F.col(column), p))).alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("_n"))
    grid = reads.sparkSession.range(16).select(F.concat(F.floor(F.col("id") / 4).cast("string"), (F.col("id") % 4).cast("string")).alias("pair"))
    return grid.join(seen, "pair", "left").select("pair", (F.coalesce("_n", F.lit(0)) + pseudo).alias("n"))


def some_panels(panels: DataFrame, n: int, seed: int | None = None, column: str = "panel") -> DataFrame:
    """The first ``n`` panels, or with a seed ``n`` chosen by hash; ``n`` is the feature."""
    order = [column] if seed is None else [F.xxhash64(F.lit(seed), F.col(column)), F.col(column)]
    return panels.select(column).distinct().orderBy(*order).limit(n)


def panel_groups(panels: DataFrame, n: int, column: str = "panel") -> DataFrame:
    """Panels in ``n`` groups of equal size, in order."""
    rows = numbered(panels.select(column).distinct(), [column], "_place")
    total = rows.agg(F.count(F.lit(1)).alias("_all"))  # one row
    small, more = F.floor(F.col("_all") / n), F.col("_all") % n
    # the first groups hold one more, as ntile has it
    edge, at = more * (small + 1), F.col("_place") - 1
    group = F.when(at < edge, F.floor(at / (small + 1))).otherwise(more + F.floor((at - edge) / F.greatest(small, F.lit(1)))) + 1
    return rows.crossJoin(F.broadcast(total)).withColumn("panel_group", group.cast("int")).drop("_place", "_all")


def sequence_matches(reads: DataFrame, contigs: DataFrame, length: int, most: int, chunk: int = 1 << 8) -> DataFrame:
    """Base-space mapping: (read_id, contig, pos0, strand, mm) of reads (read_id, seq) with at most ``most`` differing bases."""
    from ..functions.color import mismatches, reverse_complement
    from .mapping import MOST_SENT, blocks, chunk_reference

    usable = F.least(F.lit(chunk), F.length("seq") - length + 1)
    ref = chunk_reference(contigs, chunk, length).where(usable >= 1).withColumn("_i", F.explode(F.sequence(F.lit(0), usable - 1)))
    ref = ref.select("contig", (F.col("chunk_start") + F.col("_i")).alias("pos0"), F.substring(F.col("seq"), F.col("_i") + 1, F.lit(length)).alias("ref")).where(~F.col("ref").contains("."))
    query = reads.where(F.length("seq") >= length).select("read_id", F.left("seq", F.lit(length)).alias("query"))
    both = query.withColumn("strand", F.lit("+")).unionByName(query.select("read_id", reverse_complement(F.col("query")).alias("query"), F.lit("-").alias("strand")))

    def keyed(df: DataFrame, column: str) -> DataFrame:
        seeds = F.array(*[F.struct(F.lit(i).alias("block"), F.substring(F.col(column), a + 1, b - a).alias("key")) for i, (a, b) in enumerate(blocks(length, most))])
        return df.withColumn("_seed", F.explode(seeds)).select("*", "_seed.*").drop("_seed")

    seeds = cut(keyed(both, "query"))
    seeds = seeds if seeds.count() <= MOST_SENT else seeds.hint("merge")
    hits = keyed(ref, "ref").join(seeds, ["block", "key"]).withColumn("mm", mismatches(F.col("query"), F.col("ref")))
    return hits.where(F.col("mm") <= most).select("read_id", "contig", "pos0", "strand", "mm").dropDuplicates(["read_id", "contig", "pos0", "strand"])


def feature_positions(features: DataFrame) -> DataFrame:
    """One row per base of each feature (contig, start1, end1, ...); prefer ``interval_join``, which needs no expansion."""
    return features.withColumn("pos1", F.explode(F.sequence("start1", "end1")))


def bead_order(*names: str) -> list[Column]:
    """Sort columns of bead ids."""
    return [F.col(n) for n in (names or ("panel", "x", "y"))]
