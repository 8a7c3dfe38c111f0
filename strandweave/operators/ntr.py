"""Novel transcribed regions: parameter sweep, matching with annotation, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..lineage import cut
from .coverage import window_islands
from .intervals import interval_join


def sweep(runs: DataFrame, windows: list[int], coverages: list[int]) -> DataFrame:
    """Regions for every window size and minimum coverage, in one job."""
    spark = runs.sparkSession
    params = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(w).cast("bigint").alias("window"), F.lit(c).cast("bigint").alias("min_coverage")) for w in windows for c in coverages])).alias("x")).select("x.*")
    return window_islands(runs, ["contig", "strand"], params)


def matched(regions: DataFrame, features: DataFrame, percent: int) -> DataFrame:
    """Pairs of regions (start0, end0) and features (fs0, fe0) of which either is covered by ``percent`` or more."""
    hit = interval_join(regions, features, ["contig", "strand"], ("start0", "end0", "fs0", "fe0"))
    shared = F.least("end0", "fe0") - F.greatest("start0", "fs0") + 1
    hit = hit.withColumn("ptr_overlap", shared / (F.col("end0") - F.col("start0") + 1)).withColumn("atr_overlap", shared / (F.col("fe0") - F.col("fs0") + 1))
    return hit.where(F.greatest("ptr_overlap", "atr_overlap") * 100 >= percent)


def summary(regions: DataFrame, features: DataFrame, percent: int) -> DataFrame:
    """Per parameter pair: regions, matched regions and features, and mean overlaps (of each one's best)."""
    own = ["window", "min_coverage"]
    regions = cut(regions)
    hits = matched(regions, features, percent)
    by_ptr = hits.groupBy(*own, "contig", "strand", "start0", "end0").agg(F.max("ptr_overlap").alias("o")).groupBy(*own).agg(F.count(F.lit(1)).alias("n_ptr_matched"), F.avg("o").alias("mean_ptr_overlap"))
    by_atr = hits.groupBy(*own, "feature_id").agg(F.max("atr_overlap").alias("o")).groupBy(*own).agg(F.count(F.lit(1)).alias("n_atr_matched"), F.avg("o").alias("mean_atr_overlap"))
    every = regions.groupBy(*own).agg(F.count(F.lit(1)).alias("n_ptr"), F.sum(F.col("end0") - F.col("start0") + 1).alias("bases"))
    zero = F.lit(0).cast("bigint")
    return every.join(by_ptr, own, "left").join(by_atr, own, "left").select(*own, "n_ptr", "bases", F.coalesce("n_ptr_matched", zero).alias("n_ptr_matched"), F.coalesce("n_atr_matched", zero).alias("n_atr_matched"), F.round("mean_ptr_overlap", 6).alias("mean_ptr_overlap"), F.round("mean_atr_overlap", 6).alias("mean_atr_overlap"))


def dense_enough(summaries: DataFrame, bases: int, per_mb: int) -> DataFrame:
    """Parameter pairs with at most ``per_mb`` regions a million bases."""
    return summaries.where(F.col("n_ptr") * 1_000_000 <= F.lit(per_mb) * bases)


def merge_means(parts: DataFrame, keys: list[str], mean: str, n: str) -> DataFrame:
    """Means of parts (each with its count) as one mean."""
    return parts.groupBy(*keys).agg((F.sum(F.col(mean) * F.col(n)) / F.sum(n)).alias(mean), F.sum(n).alias(n))


def curves(summaries: DataFrame, across: str = "min_coverage", own: tuple[str, ...] = ("window",)) -> DataFrame:
    """The series of a chart, a row a point: (the ``own`` columns, measure, x, y) for every other column over ``across``."""
    measures = [c for c in summaries.columns if c != across and c not in own]
    rows = summaries.select(*own, F.col(across).alias("x"), *[F.col(c).cast("double").alias(c) for c in measures])
    return rows.unpivot([*own, "x"], measures, "measure", "y").select(*own, "measure", "x", "y")
