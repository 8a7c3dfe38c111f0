"""Writers of the line formats; coordinates turn 1-based here."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_lines(rows: DataFrame, path: str, header: Mapping[str, str] | None = None) -> None:
    """Text files of one ``value`` column; provenance goes to a side file of ``#key=value`` lines."""
    rows.select("value").write.mode("overwrite").text(path)
    if header:
        lines = [(f"#{k}={v}",) for k, v in header.items()]
        rows.sparkSession.createDataFrame(lines, "value string").coalesce(1).write.mode("overwrite").text(f"{path.rstrip('/')}.header")


def _dot(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("."))


def fasta_lines(sequences: DataFrame, width: int = 60) -> DataFrame:
    body = F.regexp_replace("seq", f"(.{{{width}}})(?=.)", "$1\n")
    return sequences.select(F.concat(F.lit(">"), F.col("header"), F.lit("\n"), body).alias("value"))


def alignment_lines(alignments: DataFrame, with_pairs: bool = False) -> DataFrame:
    """One ``>id,ref.pos.start.len.score.mm#va##`` line a read; alignments by score, contig, position."""
    ins = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["pos"].cast("string"), x["len"].cast("string"))), ";")
    va = F.array_join(F.col("va").cast("array<string>"), ".") if with_pairs else F.lit("")
    pos = F.when(F.col("strand") == "-", F.concat(F.lit("-"), F.col("pos0").cast("string"))).otherwise(F.col("pos0").cast("string"))
    text = F.concat(F.concat_ws(".", F.col("contig_idx").cast("string"), pos, *[F.col(c).cast("string") for c in ("read_start", "aln_len", "score", "mm")]), F.lit("#"), F.coalesce(va, F.lit("")), F.lit("#"), F.coalesce(ins("ins_read"), F.lit("")), F.lit("#"), F.coalesce(ins("ins_ref"), F.lit("")))
    key = F.struct((-F.col("score")).alias("s"), "contig_idx", "pos0", "strand", text.alias("text"))
    return alignments.groupBy("read_id").agg(F.sort_array(F.collect_list(key)).alias("a")).select(F.concat(F.lit(">"), F.col("read_id"), F.lit(","), F.array_join(F.transform("a", lambda x: x["text"]), ",")).alias("value"))


def feature_lines(features: DataFrame) -> DataFrame:
    """GFF rows of FEATURES columns, by contig and start."""
    columns = ("contig_id", "source", "ftype", "start1", "end1", "score", "strand", "phase", "attributes")
    return features.orderBy("contig_id", "start1", "end1", "strand").select(F.concat_ws("\t", *[_dot(F.col(c)) for c in columns]).alias("value"))


def hit_features(hits: DataFrame, source: str = "strandweave") -> DataFrame:
    """FEATURES rows of unique hits: one for a genomic hit, two (the flanks' parts) for a junction hit with ``parts``, an array of (start0, end0); columns rs, g, i, jp and jt become attributes."""
    rows = hits.withColumn("parts", F.coalesce("parts", F.array(F.struct(F.col("start0"), F.col("end0"))))) if "parts" in hits.columns else hits.withColumn("parts", F.array(F.struct(F.col("start0"), F.col("end0"))))
    more = [x for c in ("rs", "g", "i", "jp", "jt") if c in hits.columns for x in (F.lit(f";{c}="), _dot(F.col(c)))]
    attributes = F.concat(F.lit("bd="), F.col("read_id").cast("string"), F.lit(";mm="), F.col("mm").cast("string"), *more)
    return rows.select(F.col("contig").alias("contig_id"), F.lit(source).alias("source"), F.lit("read").alias("ftype"), F.explode("parts").alias("p"), F.col("score").cast("string").alias("score"), "strand", F.lit(None).cast("string").alias("phase"), attributes.alias("attributes")).select("contig_id", "source", "ftype", (F.col("p.start0") + 1).alias("start1"), (F.col("p.end0") + 1).alias("end1"), "score", "strand", "phase", "attributes")


def region_features(regions: DataFrame, source: str = "strandweave") -> DataFrame:
    """FEATURES rows of transcribed regions with coverage and best overlaps, numbered in order."""
    from ..operators.intervals import running

    numbered = running(regions.withColumn("_one", F.lit(1)), ["contig", "strand"], "start0", {"_no": ("_one", "sum")}, order=["end0"])
    attributes = F.concat(F.lit("ID="), F.concat_ws("_", "contig", "strand", F.col("_no").cast("string")), *[x for c in ("coverage", "atr_match", "atr_overlap", "ptr_overlap") if c in regions.columns for x in (F.lit(f";{c}="), _dot(F.col(c)))])
    return numbered.select(F.col("contig").alias("contig_id"), F.lit(source).alias("source"), F.lit("region").alias("ftype"), (F.col("start0") + 1).alias("start1"), (F.col("end0") + 1).alias("end1"), F.lit(None).cast("string").alias("score"), "strand", F.lit(None).cast("string").alias("phase"), attributes.alias("attributes"))


def count_features(features: DataFrame, counts: DataFrame, key: str = "feature_id") -> DataFrame:
    """Feature rows with the count in the phase column; zeros stay."""
    return features.drop("phase").join(counts, key, "left").withColumn("phase", F.coalesce("n_reads", F.lit(0).cast("bigint")).cast("string")).drop("n_reads")


def write_wig(coverage_runs: DataFrame, path: str, least: int = 1) -> None:
    """Coverage as variableStep tracks, a folder for each strand and contig; positions are 1-based, a line a base."""
    rows = coverage_runs.where(F.col("depth") >= least)
    lines = rows.select("strand", "contig", "start0", F.explode(F.sequence(F.col("start0") + 1, F.col("end0_excl"))).alias("_p"), "depth")
    first = rows.groupBy("strand", "contig").agg(F.lit(-1).cast("bigint").alias("_p")).select("strand", "contig", "_p", F.concat(F.lit("variableStep chrom="), F.col("contig")).alias("value"))
    body = lines.select("strand", "contig", "_p", F.concat_ws(" ", F.col("_p").cast("string"), F.col("depth").cast("string")).alias("value"))
    both = first.unionByName(body).withColumn("track", F.concat_ws("_", F.when(F.col("strand") == "-", "minus").otherwise("plus"), "contig"))
    both.repartition("track").sortWithinPartitions("track", "_p").select("track", "value").write.mode("overwrite").partitionBy("track").text(path)


def gtf_rows(transcripts: DataFrame) -> DataFrame:
    """start_codon, CDS and exon rows (FEATURES) of transcript rows; frames 1 and 2 change places as phases."""
    names = F.concat(F.lit('gene_id "'), F.col("name2"), F.lit('"; transcript_id "'), F.col("name"), F.lit('"; '))
    base = transcripts.select("*", names.alias("attributes"), F.posexplode(F.arrays_zip("exon_starts", "exon_ends", "exon_frames")).alias("exon_no", "x")).select("chrom", "strand", "cds_start", "cds_end", "exon_count", "exon_no", F.col("x.exon_starts").alias("s"), F.col("x.exon_ends").alias("e"), F.col("x.exon_frames").alias("frame"), "attributes")
    phase = F.when(F.col("frame") == 1, "2").when(F.col("frame") == 2, "1").when(F.col("frame") == 0, "0")

    def rows(df: DataFrame, kind: str, s: Column, e: Column, ph: Column) -> DataFrame:
        return df.select(F.col("chrom").alias("contig_id"), F.lit("transcripts").alias("source"), F.lit(kind).alias("ftype"), s.alias("start1"), e.alias("end1"), F.lit("0.000000").alias("score"), "strand", ph.alias("phase"), "attributes")

    none = F.lit(None).cast("string")
    coding = base.where("cds_start <= cds_end and s <= cds_end and e >= cds_start")
    cs, ce = F.greatest("s", "cds_start"), F.least("e", "cds_end")
    plus, minus = F.col("strand") != "-", F.col("strand") == "-"
    opens = coding.where((plus & F.col("cds_start").between(F.col("s"), F.col("e"))) | (minus & F.col("cds_end").between(F.col("s"), F.col("e"))))
    start = rows(opens, "start_codon", F.when(plus, F.col("cds_start")).otherwise(F.greatest("s", F.col("cds_end") - 2)), F.when(plus, F.least("e", F.col("cds_start") + 2)).otherwise(F.col("cds_end")), none)
    return rows(base, "exon", F.col("s"), F.col("e"), none).unionByName(rows(coding, "CDS", cs, ce, phase)).unionByName(start)


def report_lines(counters: DataFrame, titles: Mapping[str, str]) -> list[str]:
    """Text of a one-row table of counters, with percentages of the first."""
    row = counters.first().asDict()
    whole = max(1, next(iter(row.values())) or 0)
    return [f"{titles.get(k, k)}\t{v}\t{100 * (v or 0) / whole:.1f}%" for k, v in row.items()]


def table_lines(rows: DataFrame, order: Sequence[str], titles: Mapping[str, str] | None = None) -> DataFrame:
    """Tab-separated lines of a report: its header, then its rows by ``order`` (nulls are empty); columns are value and the line's place."""
    from ..operators.intervals import numbered

    cells = F.concat_ws("\t", *[F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), "\t", "_") for c in rows.columns])
    body = numbered(rows.withColumn("value", cells), order, "place").select("value", F.col("place").cast("bigint").alias("place"))
    head = rows.sparkSession.createDataFrame([("\t".join((titles or {}).get(c, c) for c in rows.columns), 0)], "value string, place bigint")
    return head.unionByName(body)
