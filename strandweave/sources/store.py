"""Stores that can be searched: the reference by contig and chunk, and hits in reference order, both as Parquet.

Rows are range-partitioned and sorted by their place, so the files' statistics let
a scan skip what a place can't be in; there is no index file of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.alignments import in_reference_order
from ..operators.mapping import chunk_reference


def write_reference(contigs: DataFrame, path: str, chunk: int = 1 << 14) -> None:
    """Contigs (contig, seq) in chunks of ``chunk`` bases."""
    rows = chunk_reference(contigs, chunk, 0)
    rows.repartitionByRange("contig", "chunk_start").sortWithinPartitions("contig", "chunk_start").write.mode("overwrite").parquet(path)


def read_span(spark: SparkSession, path: str, contig: str, start0: int, length: int, chunk: int = 1 << 14) -> DataFrame:
    """One row with ``seq``: the bases of a contig from start0; fewer where it ends, none where it doesn't reach that far."""
    rows = spark.read.parquet(path).where((F.col("contig") == contig) & (F.col("chunk_start") > start0 - chunk) & (F.col("chunk_start") < start0 + length))
    parts = rows.agg(F.min("chunk_start").alias("first"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk_start", "seq"))), lambda x: x["seq"]), "").alias("text"))
    return parts.where("first is not null").select(F.substring(F.col("text"), (F.lit(start0) - F.col("first") + 1).cast("int"), F.lit(length)).alias("seq"))


def read_spans(spans: DataFrame, path: str, chunk: int = 1 << 14) -> DataFrame:
    """Spans (contig, start0, length, ...) with ``seq``, by an equi-join on the chunks that they touch."""
    stored = spans.sparkSession.read.parquet(path).withColumnRenamed("seq", "_piece")
    touched = F.sequence(F.floor(F.col("start0") / chunk).cast("bigint"), F.floor((F.col("start0") + F.col("length") - 1) / chunk).cast("bigint"))
    rows = spans.withColumn("_id", F.monotonically_increasing_id()).withColumn("_no", F.explode(touched)).withColumn("chunk_start", F.col("_no") * chunk)
    low = F.greatest(F.col("start0") - F.col("chunk_start"), F.lit(0))
    high = F.least(F.col("start0") + F.col("length") - F.col("chunk_start"), F.lit(chunk))
    cut = rows.join(stored, ["contig", "chunk_start"]).withColumn("_part", F.substring(F.col("_piece"), (low + 1).cast("int"), (high - low).cast("int")))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk_start", "_part"))), lambda x: x["_part"]), "")
    return cut.groupBy("_id", *spans.columns).agg(text.alias("seq")).drop("_id")


def write_hits(hits: DataFrame, path: str) -> None:
    in_reference_order(hits).write.mode("overwrite").parquet(path)


def hits_from(spark: SparkSession, path: str, contig: str, start0: int, most: int | None = None) -> DataFrame:
    """Stored hits of a contig from a position on, in order; ``most`` of them if given."""
    rows = spark.read.parquet(path).where((F.col("contig") == contig) & (F.col("start0") >= start0)).orderBy("start0", "strand")
    return rows if most is None else rows.limit(most)
