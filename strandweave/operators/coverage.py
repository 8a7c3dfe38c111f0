"""Coverage by event sweep, and what is read off it: islands, windows, trims."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..lineage import cut
from .intervals import BLOCK, cluster, interval_join, running


def _steps(df: DataFrame, keys: Sequence[str], start: str, end: str, weight: str | None) -> DataFrame:
    """Net change of depth at each position where it changes; summed before any shuffle."""
    w = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    both = F.array(F.struct(F.col(start).cast("bigint").alias("at"), w.alias("d")), F.struct((F.col(end) + 1).cast("bigint").alias("at"), (-w).alias("d")))
    events = df.select(*keys, F.explode(both).alias("x")).select(*keys, "x.at", "x.d")
    return events.groupBy(*keys, "at").agg(F.sum("d").alias("d")).where("d <> 0")


def coverage(df: DataFrame, keys: Sequence[str], start: str = "start0", end: str = "end0", weight: str | None = None, block: int = BLOCK) -> DataFrame:
    """Run-length coverage (keys, start0, end0_excl, depth), depth > 0.  ``end`` is inclusive; ``weight`` an integer column."""
    depth = running(_steps(df, keys, start, end, weight), keys, "at", {"depth": ("d", "sum")}, block)
    return _until_next(depth, keys, "at", block).select(*keys, F.col("at").alias("start0"), F.col("_next").alias("end0_excl"), "depth").where("depth > 0")


def _until_next(df: DataFrame, keys: Sequence[str], at: str, block: int) -> DataFrame:
    """Appends the next position within keys (null for the last), block by block."""
    own = Window.partitionBy(*keys, "_block").orderBy(at)
    blocks = df.withColumn("_block", F.floor(F.col(at) / block).cast("bigint"))
    rows = cut(blocks.select("*", F.lead(at).over(own).alias("_next"), F.lag(F.lit(True), 1, False).over(own).alias("_on")))
    later = rows.where(~F.col("_on")).select(*keys, "_block", F.lead(at).over(Window.partitionBy(*keys).orderBy("_block")).alias("_later"))
    return rows.join(later, [*keys, "_block"]).select(*df.columns, F.coalesce("_next", "_later").alias("_next"))


def above(runs: DataFrame, keys: Sequence[str], least: int, block: int = BLOCK) -> DataFrame:
    """Maximal stretches with depth >= ``least``: start0, end0_excl."""
    high = runs.where(F.col("depth") >= least).withColumn("_last", F.col("end0_excl") - 1)
    merged = cluster(high, keys, "start0", "_last", gap=1, block=block)
    return merged.select(*keys, F.col("start").alias("start0"), (F.col("end") + 1).alias("end0_excl"))


def low_islands(runs: DataFrame, keys: Sequence[str], most: int, gap: int, longest: int, block: int = BLOCK) -> DataFrame:
    """Stretches of depth <= ``most`` between covered positions; those at most ``gap`` positions apart are joined, and islands up to ``longest`` positions stay."""
    runs = cut(runs)
    nexts = _until_next(runs, keys, "start0", block)
    holes = nexts.where(F.col("_next") > F.col("end0_excl")).select(*keys, F.col("end0_excl").alias("start0"), (F.col("_next") - 1).alias("_last"))
    low = runs.where(F.col("depth") <= most).select(*keys, "start0", (F.col("end0_excl") - 1).alias("_last")).unionByName(holes)
    joined = cluster(low, keys, "start0", "_last", gap=gap + 1 if gap >= 0 else 0, block=block)
    return joined.where(F.col("end") - F.col("start") + 1 <= longest).select(*keys, F.col("start").alias("start0"), F.col("end").alias("end0"))


def window_islands(runs: DataFrame, keys: Sequence[str], params: DataFrame, block: int = BLOCK) -> DataFrame:
    """Regions where a sliding window holds enough coverage.

    ``params`` has rows (window w, min_coverage t): a position p counts where the
    depth summed over p-w+1..p is at least t*w; counting positions that follow each
    other form a region, which starts w-1 positions before the first of them.
    Nothing is expanded to single bases: the window sum is piecewise linear between
    run borders and the borders shifted by w, and each piece is solved for its crossing.
    """
    # slope of the cumulated coverage changes by depth at a run's ends; the window's slope is C'(p) - C'(p-w)
    ends = F.array(
        F.struct(F.col("start0").alias("at"), F.col("depth").alias("d")), F.struct(F.col("end0_excl").alias("at"), (-F.col("depth")).alias("d")),
        F.struct((F.col("start0") + F.col("window")).alias("at"), (-F.col("depth")).alias("d")), F.struct((F.col("end0_excl") + F.col("window")).alias("at"), F.col("depth").alias("d")),
    )
    own = [*keys, "window", "min_coverage"]
    events = runs.select(*keys, "start0", "end0_excl", "depth").crossJoin(F.broadcast(params)).select(*own, F.explode(ends).alias("x")).select(*own, "x.at", "x.d").groupBy(*own, "at").agg(F.sum("d").alias("d"))
    slope = running(events, own, "at", {"slope": ("d", "sum")}, block)
    pieces = _until_next(slope, own, "at", block).where("_next is not null")
    pieces = pieces.withColumn("_gain", F.col("slope") * (F.col("_next") - F.col("at")))
    total = running(pieces, own, "at", {"_sum_end": ("_gain", "sum")}, block)
    # window sum at position at + i (0 <= i < _next - at): base + slope * (i + 1)
    base, need = F.col("_sum_end") - F.col("_gain"), F.col("min_coverage") * F.col("window")
    n = F.col("_next") - F.col("at")
    lack = need - base
    up = F.greatest(F.lit(0), F.ceil(lack / F.col("slope")) - 1)  # first i with base + slope * (i + 1) >= need
    down = F.floor(-lack / -F.col("slope")) - 1  # last such i on a falling piece
    first = F.when(F.col("slope") > 0, up).otherwise(F.lit(0)).cast("bigint")
    last = F.when(F.col("slope") < 0, F.least(n - 1, down)).otherwise(n - 1).cast("bigint")
    ok = F.when(F.col("slope") == 0, base >= need).otherwise(first <= last)
    spans = total.where(ok).select(*own, (F.col("at") + first).alias("_a"), (F.col("at") + last).alias("_b"))
    joined = cluster(spans, own, "_a", "_b", gap=1, block=block)
    return joined.select(*own, (F.col("start") - F.col("window") + 1).alias("start0"), F.col("end").alias("end0"))


def mean_depth(regions: DataFrame, runs: DataFrame, keys: Sequence[str], start: str = "start0", end: str = "end0") -> DataFrame:
    """Appends ``area`` (summed depth) and ``mean_depth`` of each region; regions must be distinct rows."""
    regions = cut(regions)
    right = runs.select(*keys, F.col("start0").alias("_rs"), (F.col("end0_excl") - 1).alias("_re"), "depth")
    pairs = interval_join(regions, right, keys, (start, end, "_rs", "_re"))
    part = pairs.withColumn("_part", F.col("depth") * (F.least(end, "_re") - F.greatest(start, "_rs") + 1))
    area = part.groupBy(*regions.columns).agg(F.sum("_part").alias("area"))
    return regions.join(area, regions.columns, "left").withColumn("area", F.coalesce("area", F.lit(0))).withColumn("mean_depth", F.col("area") / (F.col(end) - F.col(start) + 1))


def trim(regions: DataFrame, runs: DataFrame, keys: Sequence[str], percent: int, start: str = "start0", end: str = "end0") -> DataFrame:
    """Regions without the end positions whose depth is below ``percent`` per cent of the region's mean; regions that keep no position go."""
    right = runs.select(*keys, F.col("start0").alias("_rs"), (F.col("end0_excl") - 1).alias("_re"), "depth")
    mean = mean_depth(regions, runs, keys, start, end)
    pairs = interval_join(mean, right, keys, (start, end, "_rs", "_re"))
    keep = pairs.where(F.col("depth") * 100 * (F.col(end) - F.col(start) + 1) >= F.col("area") * percent)
    return keep.groupBy(*regions.columns, "area").agg(F.min(F.greatest(start, "_rs")).alias("trimmed_start0"), F.max(F.least(end, "_re")).alias("trimmed_end0"))
