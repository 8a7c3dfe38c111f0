"""From placements to scored hits: reference colours beside hits, extension, and mapping onto junctions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.color import encode_colors
from .alignments import unique_best
from .extension import extend_hits
from .mapping import chunk_reference, map_reads


def with_reference(hits: DataFrame, contigs: DataFrame, length: int, chunk: int = 1 << 8) -> DataFrame:
    """Hits (contig, pos0, strand) with ``ref_seq`` and ``ref_colors`` of ``length`` bases from pos0, in the read's direction; hits whose span leaves the contig go.

    The reference is cut into chunks that overlap by ``length``, so a hit meets one
    chunk, by an equi-join.
    """
    pieces = chunk_reference(contigs, chunk, length).select("contig", F.col("chunk_start").alias("_start"), F.col("seq").alias("_seq"))
    rows = hits.withColumn("_start", (F.floor(F.col("pos0") / chunk) * chunk).cast("bigint")).join(pieces, ["contig", "_start"])
    span = F.substring(F.col("_seq"), (F.col("pos0") - F.col("_start") + 1).cast("int"), F.lit(length))
    rows = rows.withColumn("ref_seq", span).where((F.col("pos0") >= 0) & (F.length("ref_seq") == length)).drop("_start", "_seq")
    colors = encode_colors(F.col("ref_seq"))
    # the reverse complement has the same colours in reverse
    return rows.withColumn("ref_colors", F.when(F.col("strand") == "-", F.reverse(colors)).otherwise(colors))


def map_and_extend(reads: DataFrame, contigs: DataFrame, seed: int, length: int, most: int, adjacent: bool = False, mask: str = "") -> DataFrame:
    """Hits of reads (read_id, primer, colors) placed by their first ``seed`` colours and scored over ``length``.

    A minus-strand hit ends where its seed ends, so its span starts length - seed
    positions before.  Columns of ``map_reads`` and ``extend_hits``.
    """
    placed = map_reads(reads, contigs, seed, most, adjacent).withColumnRenamed("mm", "seed_mm")
    start = F.when(F.col("strand") == "-", F.col("pos0") - (length - seed)).otherwise(F.col("pos0"))
    spans = with_reference(placed.withColumn("pos0", start), contigs, length)
    rows = spans.join(reads.select("read_id", F.substring("colors", 2, length - 1).alias("read_colors")), "read_id")
    return extend_hits(rows.drop("ref_seq"), mask, adjacent=True)


def unique_placements(hits: DataFrame, gap: int, min_possible: int) -> DataFrame:
    """The unique best of extended hits."""
    return unique_best(hits.withColumn("start0", F.col("pos0")), gap, min_possible, ties=("contig", "start0", "strand"))


def map_to_junctions(reads: DataFrame, junctions: DataFrame, length: int, most: int, adjacent: bool = False) -> DataFrame:
    """Hits of reads on junction sequences (junction_no, seq): read_id, junction_no, start0, aln_len, strand, mm, score."""
    contigs = junctions.select(F.col("junction_no").cast("string").alias("contig"), "seq")
    hits = map_reads(reads, contigs, length, most, adjacent)
    kind = junctions.schema["junction_no"].dataType.simpleString()
    return hits.select("read_id", F.col("contig").cast(kind).alias("junction_no"), F.col("pos0").alias("start0"), F.lit(length).cast("bigint").alias("aln_len"), "strand", "mm", (F.lit(length) - 2 * F.col("mm")).cast("bigint").alias("score"))
