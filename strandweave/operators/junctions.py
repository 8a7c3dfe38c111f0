"""Splice junctions from exons, their sequences and lift-over."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.color import reverse_complement

KEY = ("contig", "strand", "gene_id", "left_end1", "right_start1")


def known(exons: DataFrame, flank: int) -> DataFrame:
    """Junctions of neighbouring exons of a transcript (contig, strand, gene_id, transcript_id, start1, end1), flanks clipped to the exons."""
    w = Window.partitionBy("contig", "strand", "gene_id", "transcript_id").orderBy("start1", "end1")
    pairs = exons.select("*", F.lead("start1").over(w).alias("rs"), F.lead("end1").over(w).alias("re")).where("end1 < rs")
    return _flanked(pairs, flank).groupBy(*KEY).agg(F.min("left_start1").alias("left_start1"), F.max("right_end1").alias("right_end1"), F.lit(True).alias("is_known"))


def putative(exons: DataFrame, known_junctions: DataFrame, flank: int) -> DataFrame:
    """All other pairs of exons of a gene where one ends before the other starts; a known junction wins over its putative twin.

    The self join is by gene, whose exons are few; each distinct exon counts once.
    """
    one = exons.groupBy("contig", "strand", "gene_id", "start1", "end1").agg(F.lit(1).alias("_n")).drop("_n")
    right = one.select("contig", "strand", "gene_id", F.col("start1").alias("rs"), F.col("end1").alias("re"))
    pairs = _flanked(one.join(right, ["contig", "strand", "gene_id"]).where("end1 < rs"), flank)
    found = pairs.groupBy(*KEY).agg(F.min("left_start1").alias("left_start1"), F.max("right_end1").alias("right_end1"), F.lit(False).alias("is_known"))
    return found.join(known_junctions.select(*KEY), list(KEY), "left_anti")


def _flanked(pairs: DataFrame, flank: int) -> DataFrame:
    return pairs.select("contig", "strand", "gene_id", F.greatest("start1", F.col("end1") - flank + 1).alias("left_start1"), F.col("end1").alias("left_end1"), F.col("rs").alias("right_start1"), F.least("re", F.col("rs") + flank - 1).alias("right_end1"))


def sequences(junctions: DataFrame, chunks: DataFrame, chunk: int) -> DataFrame:
    """Appends ``seq``: both flanks joined, reverse-complemented on the minus strand.

    ``chunks`` (contig, chunk_start, seq) holds the reference in pieces that start at
    multiples of ``chunk`` and are long enough to hold a flank that starts in them.
    """
    piece = chunks.select(F.col("contig"), F.col("chunk_start").alias("_start"), F.col("seq").alias("_seq"))
    start = lambda c: (F.floor((F.col(c) - 1) / chunk) * chunk).cast("bigint")
    cut = lambda a, b: F.substring(F.col("_seq"), (F.col(a) - F.col("_start")).cast("int"), (F.col(b) - F.col(a) + 1).cast("int"))
    left = junctions.withColumn("_start", start("left_start1")).join(piece, ["contig", "_start"]).withColumn("_left", cut("left_start1", "left_end1")).drop("_start", "_seq")
    both = left.withColumn("_start", start("right_start1")).join(piece, ["contig", "_start"]).withColumn("_right", cut("right_start1", "right_end1")).drop("_start", "_seq")
    seq = F.concat("_left", "_right")
    return both.withColumn("seq", F.when(F.col("strand") == "-", reverse_complement(seq)).otherwise(seq)).drop("_left", "_right")


def junction_name(known_column: str = "is_known"):
    """The text key of a junction: contig, flanks, gene, strand, kind."""
    kind = F.when(F.col(known_column), "known").otherwise("putative")
    return F.format_string("junction:%s:%d-%d|%d-%d:%s:%s:%s", "contig", "left_start1", "left_end1", "right_start1", "right_end1", "gene_id", "strand", kind)


def gene_spans(exons: DataFrame) -> DataFrame:
    """Per gene: span, and whether it lies on several contigs or on both strands."""
    return exons.groupBy("gene_id").agg(F.min("start1").alias("start1"), F.max("end1").alias("end1"), F.count_distinct("contig").alias("n_contigs"), F.count_distinct("strand").alias("n_strands"))


def duplicate_suffix(rows: DataFrame, name: str, order: list[str]) -> DataFrame:
    """Appends ``unique_name``: repeats of a name get ``_dup2``, ``_dup3`` and so on."""
    n = F.row_number().over(Window.partitionBy(name).orderBy(*order))
    return rows.withColumn("_n", n).withColumn("unique_name", F.when(F.col("_n") > 1, F.concat(F.col(name), F.lit("_dup"), F.col("_n").cast("string"))).otherwise(F.col(name))).drop("_n")
