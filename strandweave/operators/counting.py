"""Counts of alignments per feature."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import strands_fit
from .intervals import contained_join, interval_join

# Alignments have (contig, strand, start0, end0); features (feature_id, contig, f_strand, start1, end1), 1-based.


def _based(features: DataFrame) -> DataFrame:
    return features.withColumn("fs0", F.col("start1") - 1).withColumn("fe0", F.col("end1") - 1)


def contained_counts(alignments: DataFrame, features: DataFrame, slack: int = 3, width: int = 1024) -> DataFrame:
    """(feature_id, n_reads): alignments inside the feature widened by ``slack`` positions, strands fitting; zeros stay."""
    fits = strands_fit(F.col("strand"), F.col("f_strand"))
    pairs = contained_join(alignments, _based(features), ["contig"], ("start0", "end0", "fs0", "fe0"), slack, slack, fits, width)
    counts = pairs.groupBy("feature_id").agg(F.count(F.lit(1)).alias("n"))
    return features.select("feature_id").join(counts, "feature_id", "left").select("feature_id", F.coalesce("n", F.lit(0).cast("bigint")).alias("n_reads"))


def overlap_pairs(alignments: DataFrame, features: DataFrame, width: int = 1024) -> DataFrame:
    """Overlapping pairs with ``shared``, the number of common positions."""
    fits = strands_fit(F.col("strand"), F.col("f_strand"))
    pairs = interval_join(alignments, _based(features), ["contig"], ("start0", "end0", "fs0", "fe0"), fits, width)
    return pairs.withColumn("shared", F.least("end0", "fe0") - F.greatest("start0", "fs0") + 1)


def overlap_fractions(alignments: DataFrame, features: DataFrame, width: int = 1024) -> DataFrame:
    """Per feature: overlapping alignments, the most and the summed shared positions, and the greatest part of the feature that one covers."""
    pairs = overlap_pairs(alignments, features, width)
    return pairs.groupBy("feature_id").agg(F.count(F.lit(1)).alias("n_overlaps"), F.max("shared").alias("max_shared"), F.sum("shared").alias("sum_shared"), F.round(F.max(F.col("shared") / (F.col("fe0") - F.col("fs0") + 1)), 6).alias("max_fraction"))


def full_span(alignments: DataFrame, features: DataFrame, width: int = 1024) -> DataFrame:
    """Per feature: the alignments that span it whole."""
    pairs = overlap_pairs(alignments, features, width).where("shared = fe0 - fs0 + 1")
    return pairs.groupBy("feature_id").agg(F.count(F.lit(1)).alias("n_spanning"))


def start_counts(alignments: DataFrame, features: DataFrame, width: int = 1024) -> DataFrame:
    """Per feature: overlapping hits, their bases in the feature, and their distinct starts."""
    return overlap_pairs(alignments, features, width).groupBy("feature_id").agg(F.count(F.lit(1)).alias("n_hits"), F.sum("shared").alias("n_bases"), F.count_distinct("start0").alias("n_starts"))


def start_summary(counts: DataFrame) -> DataFrame:
    """Features with at least 1, 2 and 4 distinct starts, and the mean coverage in hits."""
    return counts.agg(*[F.count_if(F.col("n_starts") >= k).alias(f"n_starts_{k}") for k in (1, 2, 4)], F.avg("n_hits").alias("mean_hits"))
