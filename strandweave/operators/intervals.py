"""Interval operators: binned joins, nearest features, clusters and islands.

A range predicate alone would plan as a nested loop.  Here both sides are cut
into fixed-width bins, joined on (keys, bin), and a pair counts only in the bin
that holds the greater start, so no pair comes twice and no ``distinct`` is
needed.  One contig is then many keys, and Spark splits what is left of a skew.

Running values over a whole contig are computed in blocks of positions (see
``running``), so a contig isn't one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..lineage import cut

BIN = 1024
BLOCK = 1 << 16


def _bins(start: Column, end: Column, width: int) -> Column:
    return F.explode(F.sequence(F.floor(start / width).cast("bigint"), F.floor(F.greatest(start, end) / width).cast("bigint")))


def interval_join(left: DataFrame, right: DataFrame, on: Sequence[str], bounds: tuple[str, str, str, str], extra: Column | None = None, width: int = BIN, how: str = "inner") -> DataFrame:
    """Pairs of rows with equal ``on`` columns whose intervals overlap.

    ``bounds`` names start and end (inclusive) of the left and the right rows;
    apart from ``on`` the column names must differ.  ``how`` is inner, left_semi
    or left_anti (for these two, left rows are numbered and written first).  ``extra`` is a further condition on a pair.
    """
    ls, le, rs, re = bounds
    a = left.withColumn("_bin", _bins(F.col(ls), F.col(le), width))
    b = right.withColumn("_bin", _bins(F.col(rs), F.col(re), width))
    hit = (F.col(ls) <= F.col(re)) & (F.col(rs) <= F.col(le))
    if extra is not None:
        hit = hit & extra
    if how == "inner":
        owner = F.col("_bin") == F.floor(F.greatest(F.col(ls), F.col(rs)) / width)
        return a.join(b, [*on, "_bin"]).where(hit & owner).drop("_bin")
    rows = cut(left.withColumn("_row", F.monotonically_increasing_id()))  # written, so that a row keeps its number
    found = interval_join(rows, right, on, bounds, extra, width).select("_row").distinct()
    return rows.join(found, "_row", how).drop("_row")


def contained_join(left: DataFrame, right: DataFrame, on: Sequence[str], bounds: tuple[str, str, str, str], before: int = 0, behind: int = 0, extra: Column | None = None, width: int = BIN) -> DataFrame:
    """Pairs where the left interval lies inside the right one, widened by ``before`` and ``behind`` positions.

    Each left row needs only the bin of its start: the widened right intervals cover it.
    """
    ls, le, rs, re = bounds
    a = left.withColumn("_bin", F.floor(F.col(ls) / width).cast("bigint"))
    b = right.withColumn("_bin", _bins(F.col(rs) - before, F.col(re) + behind, width))
    hit = (F.col(ls) >= F.col(rs) - before) & (F.col(le) <= F.col(re) + behind)
    return a.join(b, [*on, "_bin"]).where(hit if extra is None else hit & extra).drop("_bin")


def running(df: DataFrame, keys: Sequence[str], at: str, values: dict[str, tuple[str, str]], block: int = BLOCK, order: Sequence[str] = (), before: bool = False) -> DataFrame:
    """Running aggregates along ``at`` within ``keys``, in blocks of positions.

    ``values`` maps new columns to (column, sum | max | min); ``order`` breaks ties of
    ``at`` (rows of one position count one after the other); with ``before``, a row's
    own value doesn't count.  Every block is a window partition of its own, dealt and
    written once; the blocks' totals (their last rows) carry over.
    """
    fold = {"sum": F.sum, "max": F.max, "min": F.min}
    own = Window.partitionBy(*keys, "_block").orderBy(at, *order)
    inside = own.rowsBetween(Window.unboundedPreceding, 0)
    earlier = own.rowsBetween(Window.unboundedPreceding, -1)
    blocks = df.withColumn("_block", F.floor(F.col(at) / block).cast("bigint"))
    rows = blocks.select("*", *[fold[f](c).over(inside).alias(f"_in_{n}") for n, (c, f) in values.items()], *[fold[f](c).over(earlier).alias(n) for n, (c, f) in values.items() if before], F.lead(F.lit(True), 1, False).over(own).alias("_on"))
    rows = cut(rows)
    over = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.where(~F.col("_on")).select(*keys, "_block", *[fold[f](F.col(f"_in_{n}")).over(over).alias(f"_before_{n}") for n, (_, f) in values.items()])
    out = rows.join(carried, [*keys, "_block"])
    join = {"sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)), "max": F.greatest, "min": F.least}
    return out.select(*df.columns, *[join[f](F.col(n if before else f"_in_{n}"), F.col(f"_before_{n}")).alias(n) for n, (_, f) in values.items()])


def numbered(df: DataFrame, order: Sequence[Column | str], out: str) -> DataFrame:
    """Appends the place (from 1) of each row in an order: sorted range partitions, and the sizes of those in front (a row each).  Ties are in no fixed order."""
    keys = [f"_order_{i}" for i in range(len(order))]
    rows = df.withColumns({k: F.col(c) if isinstance(c, str) else c for k, c in zip(keys, order, strict=True)})
    rows = cut(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_m", F.monotonically_increasing_id()).drop(*keys))
    placed = rows.withColumn("_part", F.shiftright("_m", 33)).withColumn("_in", F.col("_m") - F.shiftleft("_part", 33))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    front = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_front"))
    return placed.join(front, "_part").select(*df.columns, (F.col("_front") + F.col("_in") + 1).alias(out))


def nearest(points: DataFrame, features: DataFrame, on: Sequence[str], point: str, start: str, end: str, side: str, block: int = BLOCK) -> DataFrame:
    """For each point the distance to the nearest feature that ends left (or starts right) of it.

    Returns the points' columns, ``flank`` (the feature's near end) and
    ``distance``, both null where there is none; an inner join on (on, flank)
    brings all tied features.
    """
    mark, f = (end, "max") if side == "left" else (start, "min")
    rows = points.select(*points.columns, F.col(point).alias("_at"), F.lit(None).cast("bigint").alias("_mark"), F.lit(0 if side == "left" else 1).alias("_kind"))
    marks = features.select(*on, F.col(mark).cast("bigint").alias("_at"), F.col(mark).cast("bigint").alias("_mark"), F.lit(1 if side == "left" else 0).alias("_kind"))
    for c in points.columns:
        if c not in on:
            marks = marks.withColumn(c, F.lit(None).cast(points.schema[c].dataType))
    union = rows.unionByName(marks)
    if side == "left":
        # marks at the point's own position come behind it: strictly left only
        found = running(union, on, "_at", {"flank": ("_mark", f)}, block, ["_kind"])
        real = F.col("_kind") == 0
        gap = F.col(point) - F.col("flank")
    else:
        back = union.withColumn("_at", -F.col("_at"))
        found = running(back, on, "_at", {"flank": ("_mark", f)}, block, [F.col("_kind").desc()])
        real = F.col("_kind") == 1
        gap = F.col("flank") - F.col(point)
    return found.where(real).withColumn("distance", gap).select(*points.columns, "flank", "distance")


def cluster(df: DataFrame, keys: Sequence[str], start: str, end: str, gap: int = 0, block: int = BLOCK) -> DataFrame:
    """Clusters of intervals: start, end, n.

    With ``gap`` 0 they overlap transitively; 1 also joins intervals that touch, and
    k + 1 those with up to k free positions in between.
    """
    low = df.withColumn("_s", F.col(start).cast("bigint")).withColumn("_e", F.col(end).cast("bigint"))
    # the reach of all rows in front of a row
    opened = running(low, keys, "_s", {"_prev": ("_e", "max")}, block, ["_e"], before=True)
    opened = opened.withColumn("_new", F.when(F.col("_prev").isNull() | (F.col("_s") > F.col("_prev") + gap), 1).otherwise(0))
    # rows of one position are ordered by their end, so equal intervals stay together
    numbered = running(opened, keys, "_s", {"_no": ("_new", "sum")}, block, ["_e", F.col("_new").desc()])
    return numbered.groupBy(*keys, "_no").agg(F.min("_s").alias("start"), F.max("_e").alias("end"), F.count(F.lit(1)).alias("n")).drop("_no")
