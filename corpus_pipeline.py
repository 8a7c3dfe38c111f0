"""The corpus pipeline: quality, line dedup, near-dedup, decontamination, encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``.  BPE has no SQL form, so the pipeline
is tested against a brute-force version of its stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandweave.llm import bpe, decontaminate, lines, neardup, quality
from strandweave.llm.common import drop_tables, materialise, read, tables_made
from strandweave.llm.queries import tokenizer_file

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality.fit_quality(docs, read(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model, out="_score").where("_score >= 0.5").select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their later lines; those that lose lines and have no text left go."""
    kept = lines.dedup_lines(docs, least=1).where((F.col("n_removed") == 0) | F.col("text").rlike(r"\S"))
    return kept.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return neardup.drop_near_duplicates(docs).select(*COLUMNS)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark")).select(*COLUMNS)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and the text as decoded from them."""
    import public_tokenizers

    path, pattern = tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    out = bpe.bpe_decode(bpe.bpe_encode(docs, path, pattern).drop("text"), path, pattern)
    return out.select("doc_id", F.col("decoded").cast("string").alias("text"), "lang", "source", "n_chars", "ids", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"))


STAGES = [("quality", quality_stage), ("line dedup", line_stage), ("near-dedup", near_stage), ("decontamination", benchmark_stage), ("byte-level BPE", encode_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each is written as Parquet and reread as the next one's input, after which its own input and tables go."""
    docs, past = read(spark, sf_dir, "documents"), []
    for i, (name, stage) in enumerate(STAGES):
        with tables_made() as made:
            docs = stage(spark, docs, sf_dir)
            if i < len(STAGES) - 1:
                docs = materialise(docs, f"stage-{i}")
        if i < len(STAGES) - 1:
            drop_tables(spark, past + made, but=[docs])
            past = made
    return docs
