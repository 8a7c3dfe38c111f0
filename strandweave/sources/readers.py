"""Readers of the line formats: FASTA, reads, hit lists, alignments, gene models, variant tables.

All are plans over ``spark.read``; gzip is handled by Spark.  ``.`` is null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import types
from ..functions.scalar import attribute


def records(spark: SparkSession, path: str) -> DataFrame:
    """(header, body) of ``>`` records; comment lines in front are dropped.

    The record mark is the line separator, so a file splits between tasks like any
    text, and a record is one row whatever its number of lines.
    """
    rows = spark.read.text(path, lineSep="\n>")
    text = F.regexp_replace("value", r"^(?:#[^\n]*\n)*>?", "")
    parts = F.split(text, "\r?\n", 2)
    return rows.where(text != "").select(parts[0].alias("header"), F.regexp_replace(F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")), r"\s|#[^\n]*", "").alias("body")).where(~F.col("header").startswith("#"))


def fasta(spark: SparkSession, path: str, upper: bool = True) -> DataFrame:
    """(contig_id, header, seq): the id is the header up to the first blank."""
    seq = F.upper("body") if upper else F.col("body")
    return records(spark, path).select(F.regexp_extract("header", r"^(\S*)", 1).alias("contig_id"), "header", seq.alias("seq"))


def contigs(spark: SparkSession, path: str) -> DataFrame:
    """Ids, headers and lengths: what an index of the file would hold."""
    return fasta(spark, path).select("contig_id", "header", F.length("seq").cast("bigint").alias("length"))


def totals(contig_rows: DataFrame) -> DataFrame:
    return contig_rows.agg(F.count(F.lit(1)).alias("n_contigs"), F.sum("length").alias("bases"))


def fetch(sequences: DataFrame, header: str, prefix: bool = False) -> DataFrame:
    """Sequences whose header is (ignoring case), or starts with, the given one."""
    return sequences.where(F.col("header").startswith(header) if prefix else F.lower("header") == header.lower())


def subset(sequences: DataFrame, wanted: DataFrame, column: str = "header") -> DataFrame:
    return sequences.join(wanted.select(column).distinct(), column, "left_semi")


def csfasta(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Reads (READS); panel, x and y come from the id.  ``first``..``last`` slices by ordinal in id order."""
    rows = records(spark, path).where(F.col("body").rlike(r"^[A-Za-z][0-3.]+$"))
    p = F.split(F.regexp_extract("header", r"^([^,\s]*)", 1), "_")
    part = lambda i: F.try_element_at(p, F.lit(i))
    reads = rows.select(F.regexp_extract("header", r"^([^,\s]*)", 1).alias("read_id"), *[part(i + 1).try_cast("int").alias(c) for i, c in enumerate(("panel", "x", "y"))], part(4).alias("tag"), F.upper(F.left("body", F.lit(1))).alias("primer"), F.substring("body", 2, 1 << 30).alias("colors"))
    if first is None and last is None:
        return reads
    from ..operators.intervals import running

    numbered = running(reads.withColumn("_one", F.lit(1)).withColumn("_p", F.coalesce("panel", F.lit(0)).cast("bigint")), [], "_p", {"ordinal": ("_one", "sum")}, 1, ["x", "y", "tag", "read_id"])
    return numbered.where(F.col("ordinal").between(first or 1, last or (1 << 62))).drop("_one", "_p")


def unmapped(reads: DataFrame, hits: DataFrame) -> DataFrame:
    """Reads without any hit so far."""
    return reads.join(hits.select("read_id").distinct(), "read_id", "left_anti")


def hit_lists(spark: SparkSession, path: str) -> DataFrame:
    """Seed hits from headers ``id,seq_pos.mm,...``; a negative position is the minus strand."""
    parts = F.split("header", ",")
    rows = records(spark, path).select(parts[0].alias("read_id"), F.explode(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(1)))).alias("hit"))
    g = lambda i: F.regexp_extract("hit", r"^(\d+)_(-?\d+)\.(\d+)", i)
    return rows.where(F.col("hit").rlike(r"^\d+_-?\d+\.\d+")).select("read_id", g(1).cast("int").alias("contig_idx"), F.abs(g(2).cast("bigint")).alias("pos0"), F.when(g(2).startswith("-"), "-").otherwise("+").alias("strand"), g(3).cast("int").alias("mm"))


_MAX = r"^(\d+)\.(-?\d+)\.(\d+)\.(\d+)\.(-?\d+)\.(\d+)(?:#([^#]*))?(?:#([^#]*))?(?:#([^#]*))?$"


def _insertions(text: Column) -> Column:
    pairs = F.filter(F.split(text, ";"), lambda x: x.rlike(r"^\d+:\d+$"))
    return F.transform(pairs, lambda x: F.struct(F.split(x, ":")[0].cast("int").alias("pos"), F.split(x, ":")[1].cast("int").alias("len")))


def alignments_of(header: Column) -> Column:
    """The alignments in a header ``id,ref.pos.start.len.score.mm#va#ins#ins,...`` as an array."""
    g = lambda x, i: F.regexp_extract(x, _MAX, i)
    one = lambda x: F.struct(
        g(x, 1).cast("int").alias("contig_idx"), F.abs(g(x, 2).cast("bigint")).alias("pos0"), F.when(g(x, 2).startswith("-"), "-").otherwise("+").alias("strand"), g(x, 3).cast("int").alias("read_start"),
        g(x, 4).cast("int").alias("aln_len"), g(x, 5).cast("int").alias("score"), g(x, 6).cast("int").alias("mm"), F.transform(F.filter(F.split(g(x, 7), r"\."), lambda v: v != ""), lambda v: v.cast("int")).alias("va"),
        _insertions(g(x, 8)).alias("ins_read"), _insertions(g(x, 9)).alias("ins_ref"),
    )
    parts = F.split(header, ",")
    return F.transform(F.filter(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(1))), lambda x: x.rlike(_MAX)), one)


def alignment_lists(spark: SparkSession, path: str, split_no: int = 0) -> DataFrame:
    """Scored alignments (ALIGNMENTS), one row each."""
    rows = records(spark, path).select(F.split("header", ",")[0].alias("read_id"), F.explode(alignments_of(F.col("header"))).alias("a"))
    return rows.select("read_id", F.lit(split_no).alias("split_no"), "a.*")


def features(spark: SparkSession, path: str, widen: int = 0) -> DataFrame:
    """GFF / GTF rows (FEATURES); ``.`` is null, ``widen`` moves both ends outwards."""
    rows = spark.read.csv(path, sep="\t", comment="#", schema=types.FEATURES, quote="")
    dots = {c: F.when(F.col(c) != ".", F.col(c)) for c in ("source", "score", "phase", "attributes")}
    return rows.where("contig_id is not null and start1 is not null").withColumns(dots).withColumn("start1", F.greatest(F.lit(1), F.col("start1") - widen)).withColumn("end1", F.col("end1") + widen)


def unique_exons(feature_rows: DataFrame) -> DataFrame:
    """Each exon once, with its genes and transcripts as sorted sets."""
    rows = feature_rows.where(F.lower("ftype") == "exon").withColumn("gene_id", attribute(F.col("attributes"), "gene_id")).withColumn("transcript_id", attribute(F.col("attributes"), "transcript_id"))
    return rows.groupBy("contig_id", "strand", "start1", "end1").agg(F.sort_array(F.collect_set("gene_id")).alias("gene_ids"), F.sort_array(F.collect_set("transcript_id")).alias("transcript_ids"))


def exons(feature_rows: DataFrame) -> DataFrame:
    """Exon rows (EXONS), one for each transcript."""
    rows = feature_rows.where(F.lower("ftype") == "exon")
    return rows.select("contig_id", "strand", "start1", "end1", attribute(F.col("attributes"), "gene_id").alias("gene_id"), attribute(F.col("attributes"), "transcript_id").alias("transcript_id"))


_COLUMNS = 16


def transcripts(spark: SparkSession, path: str) -> DataFrame:
    """Transcript rows of a 16-column dump (TRANSCRIPTS); starts become 1-based.  Malformed rows are left out (see ``malformed``)."""
    c = F.split("value", "\t", -1)
    rows = spark.read.text(path).where(~F.col("value").startswith("#")).where(_well_formed())
    numbers = lambda x, t: F.transform(F.filter(F.split(x, ","), lambda v: v != ""), lambda v: v.cast(t))
    names = [x.split()[0] for x in types.TRANSCRIPTS.split(", ")]
    plain = {"bin": "int", "exon_count": "int", "id": "int", "tx_start": "bigint", "tx_end": "bigint", "cds_start": "bigint", "cds_end": "bigint"}
    out = []
    for i, n in enumerate(names):
        if n in ("exon_starts", "exon_ends"):
            v = numbers(c[i], "bigint")
            v = F.transform(v, lambda x: x + 1) if n == "exon_starts" else v
        elif n == "exon_frames":
            v = numbers(c[i], "int")
        elif n in plain:
            v = c[i].try_cast(plain[n]) + (1 if n in ("tx_start", "cds_start") else 0)
        else:
            v = c[i]
        out.append(v.alias(n))
    return rows.select(*out)


def _well_formed() -> Column:
    c = F.split("value", "\t", -1)
    count = lambda i: F.size(F.filter(F.split(c[i], ","), lambda v: v.rlike(r"^-?\d+$")))
    n = F.try_element_at(c, F.lit(9)).try_cast("int")
    return F.coalesce((F.size(c) >= _COLUMNS) & (n == count(9)) & (n == count(10)) & (n == count(15)), F.lit(False))


def malformed(spark: SparkSession, path: str) -> DataFrame:
    """Rows that ``transcripts`` leaves out."""
    return spark.read.text(path).where(~F.col("value").startswith("#")).where(~_well_formed())


def transcript_exons(rows: DataFrame) -> DataFrame:
    """An exon a row: (contig_id, strand, gene_id, transcript_id, exon_no, start1, end1, frame)."""
    zipped = F.arrays_zip("exon_starts", "exon_ends", "exon_frames")
    return rows.select(F.col("chrom").alias("contig_id"), "strand", F.col("name2").alias("gene_id"), F.col("name").alias("transcript_id"), F.posexplode(zipped).alias("exon_no", "x")).select("contig_id", "strand", "gene_id", "transcript_id", "exon_no", F.col("x.exon_starts").alias("start1"), F.col("x.exon_ends").alias("end1"), F.col("x.exon_frames").alias("frame"))


def variants(spark: SparkSession, path: str, columns: dict[str, int]) -> DataFrame:
    """Named columns (by number from 0) of a tab table of variants; alleles on the minus strand are complemented where ``alleles`` and ``strand`` are named."""
    c = F.split("value", "\t", -1)
    rows = spark.read.text(path).where(~F.col("value").startswith("#") & (F.size(c) > max(columns.values()))).select(*[c[i].alias(n) for n, i in columns.items()])
    if {"alleles", "strand"} <= set(columns):
        rows = rows.withColumn("alleles", F.when(F.col("strand") == "-", F.translate("alleles", "ACGTacgt", "TGCAtgca")).otherwise(F.col("alleles")))
    return rows


def column_file(spark: SparkSession, path: str, columns: Sequence[int], sep: str = "\t") -> DataFrame:
    """Some columns (by number from 0) of a delimited file, as c0, c1, ..."""
    rows = spark.read.csv(path, sep=sep, comment="#")
    return rows.select(*[F.col(rows.columns[c]).alias(f"c{i}") for i, c in enumerate(columns)])


def concatenated(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.text(list(paths))


def score_matrix(spark: SparkSession, path: str) -> DataFrame:
    """(position, ref_color, read_color, cost) of a file with 16 costs a line."""
    rows = spark.read.text(path).where(F.col("value").rlike(r"^\s*-?\d+(\s+-?\d+){15}\s*$"))
    costs = F.transform(F.split(F.trim("value"), r"\s+"), lambda v: v.cast("int"))
    numbered = rows.select(F.row_number().over(_file_order()).alias("position"), costs.alias("c"))
    return numbered.select("position", F.posexplode("c").alias("k", "cost")).select("position", F.floor(F.col("k") / 4).cast("int").alias("ref_color"), (F.col("k") % 4).alias("read_color"), "cost")


def _file_order():
    from pyspark.sql import Window

    return Window.orderBy(F.monotonically_increasing_id())  # one small file, read by one task


def seed_masks(spark: SparkSession, path: str) -> DataFrame:
    """(pattern_id, mask) of a file with one 0/1 mask a line."""
    rows = spark.read.text(path).where(F.col("value").rlike("^[01]+$"))
    return rows.select(F.row_number().over(_file_order()).alias("pattern_id"), F.col("value").alias("mask"))


def provenance(spark: SparkSession, path: str) -> dict[str, str]:
    """The ``#key=value`` lines of a file: a header, which is small; all of its lines."""
    rows = spark.read.text(path).where(F.col("value").rlike(r"^#[^=]+=")).select(F.regexp_extract("value", r"^#([^=]+)=", 1).alias("k"), F.regexp_extract("value", r"^#[^=]+=(.*)$", 1).alias("v"))
    return {r["k"].strip(): r["v"].strip() for r in rows.collect()}
