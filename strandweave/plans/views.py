"""Views that give the driver's tables the shapes of alignments, features, mates and sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..lineage import spread

#: Letters onto bases, in turn.
ALPHABET, ONTO = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ACGTACGTACGTACGTACGTACGTAC"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, s = F.col("l_quantity").cast("bigint"), F.col("l_suppkey")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("read_id"), F.col("l_linenumber").alias("hit_no"), F.col("l_returnflag").alias("contig"), F.when(s % 2 == 0, "+").otherwise("-").alias("strand"),
        F.col("l_partkey").alias("start0"), (F.col("l_partkey") + n - 1).alias("end0"), n.alias("aln_len"), (n - 2 * (s % 4)).alias("score"), (s % 4).alias("mm"),
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size")
    return table(spark, sf_dir, "part").select(
        k.alias("feature_id"), F.when(size % 3 == 0, "A").when(size % 3 == 1, "N").otherwise("R").alias("contig"), F.when(k % 3 == 0, "+").when(k % 3 == 1, "-").otherwise(".").alias("f_strand"),
        k.alias("start1"), (k + 5 * size).alias("end1"), F.col("p_brand").alias("gene"), F.col("p_type").alias("transcript"),
    )


def exons(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = features(spark, sf_dir)
    return f.select("contig", F.when(F.col("f_strand") == ".", "+").otherwise(F.col("f_strand")).alias("strand"), F.concat_ws("/", "gene", F.substring("transcript", 1, 4)).alias("gene_id"), F.col("transcript").alias("transcript_id"), "start1", (F.col("start1") + F.pmod("feature_id", F.lit(7))).alias("end1"))


def mates(spark: SparkSession, sf_dir: str, odd: bool) -> DataFrame:
    """Odd line numbers are one tag, even ones the other; the order is the bead."""
    a = alignments(spark, sf_dir).where(F.col("hit_no") % 2 == (1 if odd else 0))
    return a.select(F.col("read_id").alias("bead_id"), "contig", "strand", F.col("start0").alias("pos"), F.col("aln_len").alias("len"), "mm", "score")


def sequences(spark: SparkSession, sf_dir: str, name: str = "documents", key: str = "doc_id") -> DataFrame:
    seq = F.translate(F.upper(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]", "")), ALPHABET, ONTO)
    return spread(table(spark, sf_dir, name).select(key, "text")).select(key, seq.alias("seq"))
