"""Known variants, fusions and the annotation of positions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.color import complement
from ..functions.scalar import amino_acid


def near_known(candidates: DataFrame, known: DataFrame, within: int, order: list[str]) -> DataFrame:
    """Candidates (contig, pos, ...) with a known variant (contig, known_pos) less than ``within`` away, each once: the nearest, then the lowest.

    Positions are cut into bins as wide as the band, so a candidate meets three bins.
    """
    bins = candidates.withColumn("_bin", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.floor(F.col("pos") / within).cast("bigint") + d)))
    hits = bins.join(known.withColumn("_bin", F.floor(F.col("known_pos") / within).cast("bigint")), ["contig", "_bin"]).where(F.abs(F.col("pos") - F.col("known_pos")) < within)
    w = Window.partitionBy("contig", "pos", *order).orderBy(F.abs(F.col("pos") - F.col("known_pos")), "known_pos")
    return hits.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank", "_bin")


def fusions(a: DataFrame, b: DataFrame, read: str = "read_id") -> DataFrame:
    """Reads that two summaries place on different contigs."""
    return a.select(read, F.col("contig").alias("contig_a")).join(b.select(read, F.col("contig").alias("contig_b")), read).where("contig_a <> contig_b")


def fusion_counts(a: DataFrame, b: DataFrame, read: str = "read_id") -> DataFrame:
    """One row: reads in either summary only, in both, and of these the ones placed apart."""
    both = a.select(read, F.col("contig").alias("contig_a")).join(b.select(read, F.col("contig").alias("contig_b")), read, "full")
    return both.agg(F.count_if(F.col("contig_b").isNull()).alias("n_a_only"), F.count_if(F.col("contig_a").isNull()).alias("n_b_only"), F.count_if(F.col("contig_a").isNotNull() & F.col("contig_b").isNotNull()).alias("n_both"), F.count_if(F.col("contig_a") != F.col("contig_b")).alias("n_fusions"))


def coding_offsets(exons: DataFrame) -> DataFrame:
    """Exons (contig, strand, transcript_id, start0, end0, cds_start0, cds_end0) with ``cds_before``: coding bases of the transcript in front of the exon, in reading order."""
    coding = F.greatest(F.lit(0), F.least("end0", "cds_end0") - F.greatest("start0", "cds_start0") + 1)
    order = F.when(F.col("strand") == "-", -F.col("start0")).otherwise(F.col("start0"))
    w = Window.partitionBy("contig", "transcript_id").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return exons.withColumn("cds_before", F.coalesce(F.sum(coding).over(w), F.lit(0)))


def annotate_positions(positions: DataFrame, exons: DataFrame, transcripts: DataFrame, near: int = 10, width: int = 4096) -> DataFrame:
    """(contig, pos0, transcript_id, place, codon_no, codon_pos): 5'utr, 3'utr, coding, non-coding, intronic (with near_splice) or intergenic.

    ``transcripts``: (contig, strand, transcript_id, tx_start0, tx_end0, cds_start0, cds_end0); an empty CDS (start > end) is non-coding.
    """
    from .intervals import contained_join

    points = positions.select("contig", "pos0").distinct().withColumn("_p", F.col("pos0"))
    inside = contained_join(points, transcripts, ["contig"], ("pos0", "_p", "tx_start0", "tx_end0"), width=width)
    own = coding_offsets(exons).select("contig", "transcript_id", F.col("start0").alias("es"), F.col("end0").alias("ee"), "cds_before")
    hit = inside.join(own, ["contig", "transcript_id"])  # the exons of one transcript are few
    within = F.col("pos0").between(F.col("es"), F.col("ee"))
    gap = F.when(F.col("pos0") < F.col("es"), F.col("es") - F.col("pos0")).otherwise(F.col("pos0") - F.col("ee"))
    best = hit.groupBy("contig", "pos0", "transcript_id", "strand", "cds_start0", "cds_end0").agg(F.max(F.when(within, F.struct("es", "ee", "cds_before"))).alias("x"), F.min(gap).alias("gap"))
    before, behind = F.col("pos0") < F.col("cds_start0"), F.col("pos0") > F.col("cds_end0")
    place = (
        F.when(F.col("x").isNull(), "intronic").when(F.col("cds_start0") > F.col("cds_end0"), "non-coding")
        .when(F.when(F.col("strand") == "-", behind).otherwise(before), "5'utr").when(F.when(F.col("strand") == "-", before).otherwise(behind), "3'utr").otherwise("coding")
    )
    offset = F.col("x.cds_before") + F.when(F.col("strand") == "-", F.least("x.ee", "cds_end0") - F.col("pos0")).otherwise(F.col("pos0") - F.greatest("x.es", "cds_start0"))
    named = best.withColumn("place", place).withColumn("_o", F.when(F.col("place") == "coding", offset))
    found = named.select("contig", "pos0", "transcript_id", "place", F.floor(F.col("_o") / 3).cast("bigint").alias("codon_no"), (F.col("_o") % 3).cast("int").alias("codon_pos"), (F.col("x").isNull() & (F.col("gap") < near)).alias("near_splice"))
    rest = points.join(found.select("contig", "pos0").distinct(), ["contig", "pos0"], "left_anti")
    return found.unionByName(rest.select("contig", "pos0", F.lit(None).cast("string").alias("transcript_id"), F.lit("intergenic").alias("place"), F.lit(None).cast("bigint").alias("codon_no"), F.lit(None).cast("int").alias("codon_pos"), F.lit(False).alias("near_splice")))


def flanking_exons(positions: DataFrame, exons: DataFrame, block: int = 1 << 16) -> DataFrame:
    """Positions (contig, pos0) with the near ends of the exons (contig, start0, end0) left and right of them, and the steps to each; null where there is none."""
    from .intervals import nearest

    points = positions.select("contig", "pos0").distinct()
    marks = exons.select("contig", F.col("start0").alias("_s"), F.col("end0").alias("_e"))
    left = nearest(points, marks, ["contig"], "pos0", "_s", "_e", "left", block).select("contig", "pos0", F.col("flank").alias("left_end0"), F.col("distance").alias("left_steps"))
    right = nearest(points, marks, ["contig"], "pos0", "_s", "_e", "right", block).select("contig", "pos0", F.col("flank").alias("right_start0"), F.col("distance").alias("right_steps"))
    return left.join(right, ["contig", "pos0"])


def codon_changes(rows: DataFrame, codon: str = "codon", place: str = "codon_pos", strand: str = "strand") -> DataFrame:
    """Appends ``changes``: for each base put at the codon position (0-2), base and amino acid; bases are those of the plus strand."""
    def put(base):
        seen = F.when(F.col(strand) == "-", complement(F.lit(base))).otherwise(F.lit(base))
        new = F.concat(F.substring(F.col(codon), F.lit(1), F.col(place)), seen, F.substring(F.col(codon), F.col(place) + 2, F.lit(3)))
        return F.struct(F.lit(base).alias("base"), amino_acid(new).alias("amino"))

    return rows.withColumn("changes", F.array(*[put(b) for b in "ACGT"])).withColumn("amino", amino_acid(F.col(codon)))
