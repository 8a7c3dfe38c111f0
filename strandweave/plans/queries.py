"""Queries over the driver's tables: every operator on real rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import color, stats
from ..functions.scalar import natural_key
from ..lineage import cut
from ..operators import alignments as al
from ..operators import counting, coverage, extension, intervals, junctions, mapping, merging, ntr, pairs, variants
from . import views

GAP, MIN_POSSIBLE, MIN_SCORE, MAX_LOCI = 4, 10, 10, 4
TIES = ("contig", "start0", "strand", "hit_no", "aln_len")
KEYS = ["contig", "strand"]
WINDOWS, COVERAGES = (20, 50), (4, 6)


def unique_best_hit(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = al.unique_best(views.alignments(spark, sf_dir), GAP, MIN_POSSIBLE, ties=TIES)
    return found.select("read_id", "contig", "strand", "start0", "end0", "aln_len", "score", "mm", "n_hits", "second_score")


def multiplicity_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = al.multiplicity(views.alignments(spark, sf_dir), 1, MAX_LOCI)
    return found.where(F.col("score") >= MIN_SCORE).select("read_id", "hit_no", "contig", "start0", "score", "n_hits")


def _mode(mode: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return al.select_hits(views.alignments(spark, sf_dir), mode, ties=TIES).where(F.col("score") >= MIN_SCORE).select("read_id", "hit_no", "contig", "strand", "start0", "score")

    return query


top_score_hits, all_hits, single_hits, random_hits = (_mode(m) for m in ("top_score", "all", "unique", "random"))


def first_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.first_hits(views.alignments(spark, sf_dir), 2, ties=("mm", *TIES)).select("read_id", "contig", "start0", "strand", "mm")


def score_drop_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.gap_filter(views.alignments(spark, sf_dir), 5).select("read_id", "hit_no", "start0", "score")


def alignment_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.report(views.alignments(spark, sf_dir), 1, MAX_LOCI, MIN_SCORE, GAP, MIN_POSSIBLE)


def score_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.histogram(views.alignments(spark, sf_dir), F.col("score"), 5)


def score_histogram_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.histogram(views.alignments(spark, sf_dir), F.col("score"), 5, cumulative=True)


def mismatch_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = views.alignments(spark, sf_dir).select("read_id", "contig", (F.col("hit_no") % 2).alias("split_no"), "mm")
    return al.mismatch_report(tags)


def _contaminants(mode: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        reads = views.alignments(spark, sf_dir).select("read_id", (F.col("mm") == 3).alias("is_filtered"))
        return al.contamination(reads, mode)

    return query


contaminant_filter_off, contaminant_filter_one, contaminant_filter_both = (_contaminants(m) for m in ("off", "one", "both"))


def unaligned_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = views.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("read_id"))
    return al.unaligned(reads, views.alignments(spark, sf_dir), 40)


# -- features ------------------------------------------------------------------


def feature_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.contained_counts(unique_best_hit(spark, sf_dir), views.features(spark, sf_dir))


def feature_overlap_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.overlap_fractions(unique_best_hit(spark, sf_dir), views.features(spark, sf_dir))


def feature_full_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.full_span(views.alignments(spark, sf_dir), views.features(spark, sf_dir))


def feature_distinct_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.start_counts(unique_best_hit(spark, sf_dir), views.features(spark, sf_dir))


def _nearest(side: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        points = unique_best_hit(spark, sf_dir).select("read_id", "contig", F.col("start0" if side == "left" else "end0").alias("point"))
        marks = views.features(spark, sf_dir).select("contig", "feature_id", (F.col("start1") - 1).alias("s"), (F.col("end1") - 1).alias("e"))
        found = intervals.nearest(points, marks.select("contig", "s", "e"), ["contig"], "point", "s", "e", side, 1 << 12)
        tied = marks.select("contig", F.col("e" if side == "left" else "s").alias("flank"), "feature_id")
        return found.join(tied, ["contig", "flank"], "left").select("read_id", "feature_id", "distance")

    return query


nearest_left, nearest_right = _nearest("left"), _nearest("right")


def known_variant_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates are the alignments with three mismatches: a choice of the view, as for ``indel_clusters``."""
    events = views.table(spark, sf_dir, "events").select((F.col("event_id") % 3).alias("c"), F.col("user_id").alias("known_pos"))
    known = events.select(F.when(F.col("c") == 0, "A").when(F.col("c") == 1, "N").otherwise("R").alias("contig"), "known_pos").distinct()
    candidates = views.alignments(spark, sf_dir).where("mm = 3").select("contig", F.col("start0").alias("pos"), "read_id", "hit_no")
    return variants.near_known(candidates, known, 10, ["read_id", "hit_no"])


def fusion_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = views.alignments(spark, sf_dir)
    best = lambda odd: al.select_hits(hits.where(F.col("hit_no") % 2 == odd), "top_score").groupBy("read_id").agg(F.min("contig").alias("contig"))
    return variants.fusions(best(1), best(0))


def fusion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = views.alignments(spark, sf_dir)
    one = lambda odd: hits.where(F.col("hit_no") % 2 == odd).groupBy("read_id").agg(F.min("contig").alias("contig"))
    return variants.fusion_counts(one(1), one(0))


# -- coverage ------------------------------------------------------------------


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut(coverage.coverage(unique_best_hit(spark, sf_dir), KEYS, block=1 << 12))


def coverage_rle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _runs(spark, sf_dir)


def coverage_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.above(_runs(spark, sf_dir), KEYS, 4, 1 << 12)


def weighted_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    weight = F.pow(F.lit(9), 3 - F.col("mm")).cast("bigint")
    hits = views.alignments(spark, sf_dir).withColumn("w", weight)
    share = hits.withColumn("weight", F.expr("w * 1000 div sum(w) over (partition by read_id)"))
    return coverage.coverage(share.where("weight > 0"), KEYS, weight="weight", block=1 << 12)


def low_coverage_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.low_islands(_runs(spark, sf_dir), KEYS, 1, 3, 50, 1 << 12)


def window_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ntr.sweep(_runs(spark, sf_dir), [20], [4]).drop("window", "min_coverage")


def ptr_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ntr.sweep(_runs(spark, sf_dir), list(WINDOWS), list(COVERAGES))


def _annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = views.features(spark, sf_dir).where("f_strand <> '.'")
    return f.select("feature_id", "contig", F.col("f_strand").alias("strand"), (F.col("start1") - 1).alias("fs0"), (F.col("end1") - 1).alias("fe0"))


def ptr_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ntr.summary(ptr_sweep(spark, sf_dir), _annotated(spark, sf_dir), 50)


def trim_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _runs(spark, sf_dir)
    return coverage.trim(ntr.sweep(runs, [20], [4]).drop("window", "min_coverage"), runs, KEYS, 80)


def region_mean_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _runs(spark, sf_dir)
    return coverage.mean_depth(ntr.sweep(runs, [20], [4]).drop("window", "min_coverage"), runs, KEYS).withColumn("mean_depth", F.round("mean_depth", 6))


def cluster_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = views.features(spark, sf_dir).withColumn("stop1", F.col("start1") + F.col("end1") % 7)
    return intervals.cluster(f, ["contig", "f_strand"], "start1", "stop1", 0, 1 << 12)


# -- gene models ---------------------------------------------------------------

FLANK = 21


def known_junctions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return junctions.known(views.exons(spark, sf_dir), FLANK)


def putative_junctions(spark: SparkSession, sf_dir: str) -> DataFrame:
    exons = views.exons(spark, sf_dir)
    return junctions.putative(exons, junctions.known(exons, FLANK), FLANK)


def gene_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return junctions.gene_spans(views.exons(spark, sf_dir))


def dup_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return junctions.duplicate_suffix(views.features(spark, sf_dir).select("feature_id", "transcript"), "transcript", ["feature_id"]).select("feature_id", "unique_name")


def dedup_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = views.features(spark, sf_dir)
    return f.select("contig", "f_strand", "gene", "transcript").dropDuplicates()


# -- mates ---------------------------------------------------------------------


def _tags(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return views.mates(spark, sf_dir, True), views.mates(spark, sf_dir, False)


def pairs_in_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.pair_band(*_tags(spark, sf_dir), 40, 500, windows=((800, 900),)).select("bead_id", "contig", "strand", "r_pos", "f_pos", "r_mm", "f_mm", "distance")


def pair_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.pair_classes(*_tags(spark, sf_dir), 40, 500)


def pair_distance_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = pairs.pair_band(*_tags(spark, sf_dir), 0, 2000).withColumn("class", F.concat("contig", "strand"))
    return pairs.distance_histogram(good, 100)


def unique_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.unique_pairs(pairs.pair_band(*_tags(spark, sf_dir), 0, 2000)).select("bead_id", "contig", "distance")


def min_mismatch_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.best_by_mismatch(views.alignments(spark, sf_dir), ["read_id", "contig"]).select("read_id", "hit_no", "contig", "start0", "mm")


def _prepair(part: int):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        left = views.table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("bead_id"), F.col("o_orderpriority").alias("r_tag"))
        right = views.alignments(spark, sf_dir).where("mm = 0").select(F.col("read_id").alias("bead_id"), F.col("start0").alias("f_pos"))
        return pairs.prepair(left, right, "bead_id")[part]

    return query


prepair_inner, prepair_left_only, prepair_right_only = (_prepair(i) for i in range(3))


def indel_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.alignments(spark, sf_dir).where("mm = 3").select("contig", F.col("start0").alias("pos"), F.col("score").alias("size"), F.col("aln_len").alias("r_pos"), F.col("score").alias("f_pos"), F.concat_ws("_", F.col("read_id").cast("string"), F.col("hit_no").cast("string")).alias("bead_id"))
    return pairs.indel_clusters(rows, zone=1 << 12).select("contig", "start", "end", "n_unique", "n_total", "min_size", "max_size")


# -- sequences -----------------------------------------------------------------


def color_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.sequences(spark, sf_dir).select("doc_id", F.sha2(color.encode_colors(F.col("seq")), 256).alias("colors_sha256"))


def revcomp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.sequences(spark, sf_dir).select("doc_id", F.sha2(color.reverse_complement(F.col("seq")), 256).alias("revcomp_sha256"))


def color_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole sequences there and back.  The SQL shows 60 letters; a sequence that comes back otherwise, at any letter, is shown whole, so that it differs."""
    rows = views.sequences(spark, sf_dir).where("length(seq) >= 2")
    back = rows.withColumn("back", color.decode_long(F.substring("seq", 1, 1), color.encode_colors(F.col("seq"))))
    shown = F.substring("back", 1, 60)
    return back.select("doc_id", F.substring("seq", 1, 60).alias("read"), F.when(F.col("back") == F.col("seq"), shown).otherwise(F.col("back")).alias("decoded"))


def color_xor_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.sequences(spark, sf_dir).select("doc_id", color.xor_sum(color.encode_colors(F.col("seq"))).cast("int").alias("xor_sum"))


def kmer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.kmer_counts(views.sequences(spark, sf_dir), 8)


def repeat_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = views.sequences(spark, sf_dir).where("length(seq) >= 8")
    return mapping.classify_repeats(docs, mapping.kmer_counts(docs, 8), 8, 100).select("doc_id", "is_repeat")


def seed_map_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact 24-letter seeds of the probes in the documents, by diagonal."""
    k = 24
    probes = views.sequences(spark, sf_dir, "benchmark", "item_id").where(F.length("seq") >= k)
    seeds = probes.select("item_id", F.posexplode(F.transform(F.sequence(F.lit(0), F.floor(F.length("seq") / k) - 1), lambda i: F.substring(F.col("seq"), (i * k + 1).cast("int"), F.lit(k)))).alias("no", "key"))
    places = mapping.slices(views.sequences(spark, sf_dir), "seq", k, "key", "at", 256)
    # the seeds' size is known once they are written; small ones are broadcast, and no place is shuffled
    hits = places.join(cut(seeds), "key").select("item_id", "doc_id", (F.col("at") - F.col("no") * k).cast("bigint").alias("diagonal"))
    return hits.groupBy("item_id", "doc_id", "diagonal").agg(F.count(F.lit(1)).alias("n_seeds"))


def extend_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents in pieces of 50 colours, each extended along the piece behind it."""
    parts = mapping.pieces(F.col("seq"), 50, 1)
    two = F.zip_with(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    rows = views.sequences(spark, sf_dir).select("doc_id", F.posexplode(two).alias("piece", "p"))
    rows = rows.select("doc_id", "piece", color.encode_colors(F.col("p.x")).alias("read_colors"), color.encode_colors(F.col("p.y")).alias("ref_colors"))
    return extension.extend_hits(rows).select("doc_id", "piece", "score", "aln_len", "mm", "n_pairs")


def map_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads tiled over the whole benchmark items (read_id: item and offset), mapped onto the documents with up to two mismatches."""
    items = views.sequences(spark, sf_dir, "benchmark", "item_id").where("length(seq) >= 27")
    # a read's first letter is its primer, so reads overlap by one letter; the last one ends with the item
    offsets = F.expr("array_distinct(array_append(sequence(0, length(seq) - 27, 26), length(seq) - 27))")
    cut = items.select("item_id", "seq", F.explode(offsets).alias("at")).select(F.concat_ws(":", F.col("item_id").cast("string"), F.col("at").cast("string")).alias("read_id"), F.substring(F.col("seq"), F.col("at") + 1, F.lit(27)).alias("seq"))
    reads = cut.select("read_id", F.substring("seq", 1, 1).alias("primer"), color.encode_colors(F.col("seq")).alias("colors"))
    contigs = views.sequences(spark, sf_dir).select(F.col("doc_id").cast("string").alias("contig"), "seq")
    return mapping.map_reads(reads, contigs, 26, 2)


def mapability(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = views.alignments(spark, sf_dir).groupBy("read_id").agg(*[F.count_if(F.col("mm") == m).alias(f"n{m}") for m in range(4)])
    return per.select("read_id", F.round(mapping.mapability(F.array("n0", "n1", "n2", "n3"), 25), 6).alias("mapability"))


# -- others --------------------------------------------------------------------


def corr_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = F.col("l_quantity"), F.col("l_extendedprice")
    return views.table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.round(stats.pearson(x, y), 6).alias("r"), F.round(stats.pearson(x, y, True), 6).alias("r_compat"))


def var_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.col("l_quantity")
    return views.table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.round(stats.mean(x), 6).alias("mean"), F.round(stats.variance(x), 6).alias("var"), F.round(stats.variance_population(x), 6).alias("var_pop"), stats.median(x).alias("median"))


def panel_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = views.table(spark, sf_dir, "events").select((F.col("user_id") % 997).alias("panel"), "event_type")
    return e.where("event_type = 'click'").select("panel").intersect(e.where("event_type <> 'click'").select("panel"))


def equal_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merging.panel_groups(views.table(spark, sf_dir, "supplier"), 7, "s_suppkey")


def natural_sort_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.numbered(views.table(spark, sf_dir, "supplier").select("s_name"), natural_key(F.col("s_name")), "place")


QUERIES = {
    f: globals()[f]
    for f in (
        "unique_best_hit", "multiplicity_filter", "top_score_hits", "all_hits", "single_hits", "random_hits", "first_hits", "score_drop_hits", "alignment_report", "score_histogram", "score_histogram_cumulative", "mismatch_report",
        "contaminant_filter_off", "contaminant_filter_one", "contaminant_filter_both", "unaligned_reads", "feature_counts", "feature_overlap_fraction", "feature_full_span", "feature_distinct_starts", "nearest_left", "nearest_right",
        "known_variant_band", "fusion_candidates", "fusion_counts", "coverage_rle", "coverage_threshold", "weighted_coverage", "low_coverage_islands", "window_islands", "ptr_sweep", "ptr_summary", "trim_regions", "region_mean_depth", "cluster_intervals",
        "known_junctions", "putative_junctions", "gene_spans", "dup_suffix", "dedup_features", "pairs_in_band", "pair_classes", "pair_distance_hist", "unique_pairs", "min_mismatch_hits", "prepair_inner", "prepair_left_only", "prepair_right_only", "indel_clusters",
        "color_encode", "revcomp", "color_roundtrip", "color_xor_sum", "kmer_counts", "repeat_class", "seed_map_documents", "extend_score", "map_reads", "mapability", "corr_compat", "var_compat", "panel_intersection", "equal_groups", "natural_sort_rank",
    )
}
