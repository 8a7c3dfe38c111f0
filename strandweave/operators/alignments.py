"""Per-read operators: multiplicity, uniqueness, selection modes, filters, merging, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import collapse_key, junction_to_genome, spans_junction

ORDER = ("contig", "start0", "strand")


def by_score(read: str = "read_id", score: str = "score", ties: Sequence[str] = ORDER):
    return Window.partitionBy(read).orderBy(F.col(score).desc(), *ties)


def unique_best(hits: DataFrame, gap: int, min_possible: int, read: str = "read_id", score: str = "score", ties: Sequence[str] = ORDER) -> DataFrame:
    """The best hit of each read that beats the second best by ``gap`` or more; appends n_hits and second_score.

    A lone hit must reach ``min_possible - 1 + gap``, as if a hit just below the
    least possible score stood behind it.  One shuffle: all windows share a partitioning.
    """
    w = by_score(read, score, ties)
    ranked = hits.select("*", F.row_number().over(w).alias("_rank"), F.lead(score).over(w).alias("second_score"), F.count(F.lit(1)).over(Window.partitionBy(read)).cast("bigint").alias("n_hits"))
    return ranked.where((F.col("_rank") == 1) & (F.col(score) - F.coalesce("second_score", F.lit(min_possible - 1)) >= gap)).drop("_rank")


def multiplicity(hits: DataFrame, low: int, high: int, read: str = "read_id") -> DataFrame:
    """Hits of reads that have low to high of them."""
    return hits.withColumn("n_hits", F.count(F.lit(1)).over(Window.partitionBy(read)).cast("bigint")).where(F.col("n_hits").between(low, high))


def select_hits(hits: DataFrame, mode: str, read: str = "read_id", score: str = "score", ties: Sequence[str] = ORDER, seed: int = 0) -> DataFrame:
    """``unique`` (reads with one hit), ``all``, ``random`` (one of each read, by a seeded hash) or ``top_score`` (all best hits)."""
    if mode == "all":
        return hits
    if mode == "unique":
        return multiplicity(hits, 1, 1, read).drop("n_hits")
    if mode == "top_score":
        return hits.withColumn("_rank", F.rank().over(Window.partitionBy(read).orderBy(F.col(score).desc()))).where("_rank = 1").drop("_rank")
    if mode == "random":
        w = Window.partitionBy(read).orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in (read, *ties)])), *ties)
        return hits.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")
    raise ValueError(f"not a mode: {mode!r}")


def first_hits(hits: DataFrame, most: int, read: str = "read_id", ties: Sequence[str] = ("mm", *ORDER)) -> DataFrame:
    """Up to ``most`` hits of each read, in a fixed order (fewest mismatches, contig, position)."""
    return hits.withColumn("_rank", F.row_number().over(Window.partitionBy(read).orderBy(*ties))).where(F.col("_rank") <= most).drop("_rank")


def collapse(hits: DataFrame, read: str = "read_id", extra: Sequence[str] = ("contig", "strand")) -> DataFrame:
    """Of hits that place a read alike (both splits of it, say), the best; ties keep the lower split."""
    key = collapse_key(F.col("start0"), F.col("aln_len"), F.col("read_start"), F.col("strand"))
    w = Window.partitionBy(read, *extra, "_key").orderBy(F.col("score").desc(), "split_no", "start0")
    return hits.withColumn("_key", key).withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank", "_key")


def contamination(reads: DataFrame, mode: str, flag: str = "is_filtered", read: str = "read_id") -> DataFrame:
    """Reads that pass the contaminant filter: ``off`` (all), ``one`` (no split is tagged) or ``both`` (not all are)."""
    if mode == "off":
        return reads.select(read).distinct()
    tagged = reads.groupBy(read).agg(F.max(F.col(flag).cast("int")).alias("_any"), F.min(F.col(flag).cast("int")).alias("_all"))
    if mode not in ("one", "both"):
        raise ValueError(f"not a mode: {mode!r}")
    return tagged.where(F.col("_any" if mode == "one" else "_all") == 0).select(read)


def without_contaminants(hits: DataFrame, contaminant_hits: DataFrame, read: str = "read_id") -> DataFrame:
    """Hits of reads that hit no contaminant: the anti join comes before any further mapping."""
    return hits.join(contaminant_hits.select(read).distinct(), read, "left_anti")


def unaligned(reads: DataFrame, hits: DataFrame, min_score: int, read: str = "read_id") -> DataFrame:
    """Reads without a hit of the least score."""
    return reads.join(hits.where(F.col("score") >= min_score).select(read).distinct(), read, "left_anti")


def report(hits: DataFrame, low: int, high: int, min_score: int, gap: int, min_possible: int, read: str = "read_id") -> DataFrame:
    """One row of run counters, from one window over each read and one aggregate over reads."""
    w = Window.partitionBy(read).orderBy(F.col("score").desc())
    first = hits.select(read, "score", F.row_number().over(w).alias("_rank"), F.lead("score").over(w).alias("_second"), F.count(F.lit(1)).over(Window.partitionBy(read)).alias("n")).where("_rank = 1")
    per = first.select("n", F.col("score").alias("best"), "_second")
    second = F.coalesce("_second", F.lit(min_possible - 1))
    inside = F.col("n").between(low, high)
    return per.agg(
        F.count(F.lit(1)).alias("n_reads"), F.count_if(F.col("n") < low).alias("n_too_few"), F.count_if(F.col("n") > high).alias("n_too_many"), F.count_if(inside).alias("n_in_range"),
        F.count_if(inside & (F.col("best") >= min_score)).alias("n_scoring"), F.count_if(inside & (F.col("best") - second >= gap)).alias("n_unique"),
    )


def histogram(df: DataFrame, value: Column, width: int, cumulative: bool = False) -> DataFrame:
    """Frequencies of equal-width bins, named by their upper bound; optionally running totals.

    The running total is a window over the bins (one row each), not over the data.
    """
    bins = df.groupBy((F.ceil(value / width).cast("bigint") * width).alias("bin")).agg(F.count(F.lit(1)).alias("freq"))
    return bins.withColumn("freq", F.sum("freq").over(Window.orderBy("bin"))) if cumulative else bins


def merge_junction_hits(genomic: DataFrame, junction: DataFrame, junctions: DataFrame, known_penalty: int, putative_penalty: int, min_score: int, least: int = 4, strict: bool = False) -> DataFrame:
    """Genomic hits and penalised junction hits in one table; where both place a read alike, the better stays.

    Junction hits count on the plus strand only, must cover ``least`` positions of
    both flanks, and reach ``min_score`` after the penalty (``strict``: exceed it).
    They get genome positions of their first and last base.
    """
    j = junction.where("strand = '+'").join(junctions.select("junction_no", F.col("contig_id").alias("contig"), F.col("strand").alias("_gene"), F.col("left_start1"), F.col("left_end1"), F.col("right_start1"), F.col("right_end1"), "is_known"), "junction_no")
    flank = [F.col(c) for c in ("left_start1", "left_end1", "right_start1", "right_end1")]
    ll, rl = flank[1] - flank[0] + 1, flank[3] - flank[2] + 1
    zero = [c - 1 for c in flank]
    a = junction_to_genome(F.col("start0"), *zero, F.col("_gene"))
    b = junction_to_genome(F.col("start0") + F.col("aln_len") - 1, *zero, F.col("_gene"))
    score = F.col("score") - F.when(F.col("is_known"), known_penalty).otherwise(putative_penalty)
    j = j.where(spans_junction(F.col("start0"), F.col("aln_len"), ll, rl, F.col("_gene"), least)).withColumn("score", score)
    j = j.where(F.col("score") > min_score if strict else F.col("score") >= min_score)
    j = j.select("read_id", "contig", F.col("_gene").alias("strand"), F.least(a, b).alias("start0"), F.greatest(a, b).alias("end0"), "aln_len", "score", "mm", "junction_no")
    g = genomic.where(F.col("score") >= min_score).select("read_id", "contig", "strand", "start0", (F.col("start0") + F.col("aln_len") - 1).alias("end0"), "aln_len", "score", "mm", F.lit(None).cast("int").alias("junction_no"))
    both = g.unionByName(j)
    # a genomic and a junction hit are twins if they share an end on the same strand
    twin = both.alias("a").join(both.alias("b"), (F.col("a.read_id") == F.col("b.read_id")) & (F.col("a.contig") == F.col("b.contig")) & (F.col("a.strand") == F.col("b.strand")) & ((F.col("a.start0") == F.col("b.start0")) | (F.col("a.end0") == F.col("b.end0"))) & (F.col("a.junction_no").isNull() != F.col("b.junction_no").isNull()) & ((F.col("b.score") > F.col("a.score")) | ((F.col("b.score") == F.col("a.score")) & F.col("b.junction_no").isNull())), "left_anti")
    return twin


def invalid_intervals(rows: DataFrame, mode: str, start: str = "start0", end: str = "end0") -> DataFrame:
    """Rows whose interval ends before it starts: ``drop`` leaves them out, ``swap`` exchanges the ends, ``truncate`` cuts them to their start."""
    wrong = F.col(end) < F.col(start)
    if mode == "drop":
        return rows.where(~wrong)
    if mode == "swap":
        return rows.withColumns({start: F.least(start, end), end: F.greatest(start, end)})
    if mode == "truncate":
        return rows.withColumn(end, F.greatest(start, end))
    raise ValueError(f"not a mode: {mode!r}")


def inside_region(rows: DataFrame, contig: str, low: int | None = None, high: int | None = None, ftype: str | None = None, start: str = "start1", end: str = "end1", name: str = "contig") -> DataFrame:
    """Features of a type (if given) that lie inside a region."""
    hit = F.col(name) == contig
    for condition in (F.col(start) >= low if low is not None else None, F.col(end) <= high if high is not None else None, F.lower("ftype") == ftype.lower() if ftype else None):
        hit = hit if condition is None else hit & condition
    return rows.where(hit)


def progressive(reads: DataFrame, hits: DataFrame, mode: str = "hit", delta: int = 0, read: str = "read_id") -> DataFrame:
    """Reads that need another round of mapping: those without a hit (``hit``), without a perfect one (``perfect``), or whose best hit isn't ahead of the next by more than ``delta`` mismatches (``delta``)."""
    if mode == "hit":
        done = hits.select(read).distinct()
    elif mode == "perfect":
        done = hits.where("mm = 0").select(read).distinct()
    elif mode == "delta":
        w = Window.partitionBy(read).orderBy("mm")
        done = hits.select(read, "mm", F.row_number().over(w).alias("_rank"), F.lead("mm").over(w).alias("_next")).where((F.col("_rank") == 1) & (F.col("_next").isNull() | (F.col("_next") - F.col("mm") > delta))).select(read)
    else:
        raise ValueError(f"not a mode: {mode!r}")
    return reads.join(done, read, "left_anti")


def relative(bins: DataFrame, freq: str = "freq") -> DataFrame:
    """A histogram with ``share``, the part of all that each bin holds; the total is one row."""
    return bins.crossJoin(F.broadcast(bins.agg(F.sum(freq).alias("_all")))).withColumn("share", F.col(freq) / F.col("_all")).drop("_all")


def add_histograms(parts: list[DataFrame]) -> DataFrame:
    """The sum of histograms (bin, freq)."""
    from functools import reduce

    return reduce(DataFrame.unionByName, parts).groupBy("bin").agg(F.sum("freq").alias("freq"))


def rebinned(bins: DataFrame, width: int) -> DataFrame:
    """A histogram in wider bins, named by their upper bound; ``width`` is a multiple of the old one."""
    return bins.groupBy((F.ceil(F.col("bin") / width) * width).cast("bigint").alias("bin")).agg(F.sum("freq").alias("freq"))


def in_reference_order(hits: DataFrame, read: str = "read_id") -> DataFrame:
    """Hits sorted by contig, position and read: range partitions, each sorted, so files written from it are in order."""
    keys = ("contig", "start0", "strand", read)
    return hits.repartitionByRange(*keys).sortWithinPartitions(*keys)


def named_contigs(hits: DataFrame, names: DataFrame) -> DataFrame:
    """Contig names (contig_idx, contig) beside the numbers of hits; unknown numbers get null."""
    return hits.join(names, "contig_idx", "left")


def numbered_contigs(hits: DataFrame, names: DataFrame) -> DataFrame:
    return hits.join(names, "contig", "left")


def gap_filter(hits: DataFrame, drop: int, read: str = "read_id", score: str = "score") -> DataFrame:
    """Hits whose score is at most ``drop`` below the read's best."""
    return hits.withColumn("_best", F.max(score).over(Window.partitionBy(read))).where(F.col(score) >= F.col("_best") - drop).drop("_best")


def mismatch_report(tags: DataFrame, read: str = "read_id") -> DataFrame:
    """Reads by (contaminant, split, mismatches), and by contaminant those of which all splits hit it.  Columns: contig, split_no, mm."""
    one = tags.groupBy(read, "contig", "split_no").agg(F.min("mm").alias("mm"))
    splits = tags.groupBy(read, "contig").agg(F.count_distinct("split_no").alias("_n"))
    width = tags.agg(F.count_distinct("split_no").alias("_width"))
    agreed = splits.crossJoin(F.broadcast(width)).where("_n = _width").groupBy("contig").agg(F.count(F.lit(1)).alias("n_all_splits"))
    return one.groupBy("contig", "split_no", "mm").agg(F.count(F.lit(1)).alias("n_reads")).join(agreed, "contig", "left").withColumn("n_all_splits", F.coalesce("n_all_splits", F.lit(0).cast("bigint")))
