"""Mate pairs: band joins, classes, distances, rescue, indel records and clusters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .extension import NO, color_array, indel_scan

# Hits of the two tags: (bead_id, contig, strand, pos, len, mm, score); columns of the pair are prefixed r_ and f_.


def _named(hits: DataFrame, tag: str, keep: tuple[str, ...] = ("bead_id",)) -> DataFrame:
    return hits.select(*[F.col(c) if c in keep else F.col(c).alias(f"{tag}_{c}") for c in hits.columns])


def span() -> Column:
    """From the R tag's start to the F tag's end."""
    return F.col("f_pos") - F.col("r_pos") + F.col("f_len")


def pair_band(r: DataFrame, f: DataFrame, low: int, high: int, raise_low: bool = True, windows: tuple[tuple[int, int], ...] = ()) -> DataFrame:
    """Pairs of hits of one bead on one contig and strand whose span lies in low..high.

    ``raise_low``: the span must also hold both reads; ``windows`` are further
    (low, high] bands.  The bead is the join key, so the band is a residual
    condition over the few hits of a bead.
    """
    both = _named(r, "r", ("bead_id", "contig", "strand")).join(_named(f, "f", ("bead_id", "contig", "strand")), ["bead_id", "contig", "strand"])
    least = F.greatest(F.lit(low), F.col("r_len") + F.col("f_len")) if raise_low else F.lit(low)
    fits = (span() >= least) & (span() <= high)
    for a, b in windows:
        fits = fits | ((span() > a) & (span() <= b))
    return both.where(fits).withColumn("distance", span())


def pair_classes(r: DataFrame, f: DataFrame, low: int, high: int) -> DataFrame:
    """One class a bead: good, distance, strand, contig (both tags hit, but wrongly), or the one tag that hits.

    Classes are tried in this order over all pairs of hits of the bead.
    """
    both = _named(r, "r").join(_named(f, "f"), "bead_id")
    same_contig, same_strand = F.col("r_contig") == F.col("f_contig"), F.col("r_strand") == F.col("f_strand")
    kind = F.when(same_contig & same_strand & span().between(low, high), 0).when(same_contig & same_strand, 1).when(same_contig, 2).otherwise(3)
    best = both.groupBy("bead_id").agg(F.min(kind).alias("_kind"))
    single = r.select("bead_id").distinct().withColumn("_r", F.lit(True)).join(f.select("bead_id").distinct().withColumn("_f", F.lit(True)), "bead_id", "full")
    names = F.array(*[F.lit(x) for x in ("good", "distance", "strand", "contig")])
    out = F.when(F.col("_r").isNull(), "f_only").when(F.col("_f").isNull(), "r_only").otherwise(F.element_at(names, F.coalesce("_kind", F.lit(3)) + 1))
    return single.join(best, "bead_id", "left").select("bead_id", out.alias("class"))


def distance_histogram(pairs: DataFrame, width: int, kind: str = "class") -> DataFrame:
    """Pairs by class and distance bin, with a total row of each class (bin null)."""
    binned = pairs.withColumn("bin", (F.floor(F.col("distance") / width) * width).cast("bigint"))
    return binned.rollup(kind, "bin").agg(F.count(F.lit(1)).alias("n_pairs")).where(F.col(kind).isNotNull())


def unique_pairs(pairs: DataFrame) -> DataFrame:
    """Beads with exactly one good pair."""
    return pairs.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("bead_id"))).where("_n = 1").drop("_n")


def prepair(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(matched keys with both sides, left only, right only)."""
    return left.join(right, key), left.join(right.select(key).distinct(), key, "left_anti"), right.join(left.select(key).distinct(), key, "left_anti")


def best_by_mismatch(hits: DataFrame, keys: list[str]) -> DataFrame:
    """Hits with the fewest mismatches of their group."""
    return hits.withColumn("_rank", F.rank().over(Window.partitionBy(*keys).orderBy("mm"))).where("_rank = 1").drop("_rank")


def _probes(anchors: DataFrame, mates: DataFrame, chunks: DataFrame, chunk: int, low: int, high: int) -> DataFrame:
    """Each anchor with its mate's colours and every chunk that the window low..high behind it touches."""
    touch = F.sequence(F.floor((F.col("pos") + low) / chunk).cast("bigint"), F.floor((F.col("pos") + high) / chunk).cast("bigint"))
    probes = anchors.join(mates.select("bead_id", F.col("colors").alias("mate")), "bead_id").withColumn("_no", F.explode(touch))
    refs = chunks.withColumn("_no", F.floor(F.col("chunk_start") / chunk).cast("bigint")).select("contig", "_no", "chunk_start", F.col("colors").alias("ref"))
    return probes.join(refs, ["contig", "_no"]).select("bead_id", "contig", "pos", "mate", "chunk_start", "ref")


def _slabs(frame: pd.DataFrame, chunk: int, low: int, high: int, margin: int, cells: int = 1 << 22) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, mates, references, first place, number of places) of rows with mates of one length, ``cells`` colours times read places at most (or one row).

    Reference rows start ``margin`` codes in front of the first place and end ``margin``
    behind the last read's end; what lies outside the chunk has no call.
    """
    size, wide = frame["mate"].str.len().to_numpy(), frame["ref"].str.len().to_numpy()
    start = frame["chunk_start"].to_numpy()
    first = np.maximum(frame["pos"].to_numpy() + low, start)
    count = np.minimum.reduce([frame["pos"].to_numpy() + high, start + chunk - 1, start + wide - size]) - first + 1
    for n in np.unique(size[(count > 0) & (size > 0)]):
        some = np.flatnonzero((size == n) & (count > 0))
        some = some[np.argsort(count[some], kind="stable")]
        while len(some):
            rows = max(1, int(cells // ((count[some[-1]] + n + 2 * margin) * (n + 1))))
            part, some = some[-rows:], some[:-rows]
            picked, most = frame.iloc[part], int(count[part].max())
            mates_, _ = color_array(picked["mate"].tolist())
            at = first[part] - start[part]
            refs, _ = color_array([r[i : i + c + n - 1 + margin] for r, i, c in zip(picked["ref"], at, count[part], strict=True)])
            held = np.full((len(part), 2 * margin + most + n - 1), NO, np.uint8)
            held[:, margin : margin + refs.shape[1]] = refs[:, : held.shape[1] - margin]
            yield picked, mates_, held, first[part], count[part]


def rescue(anchors: DataFrame, mates: DataFrame, chunks: DataFrame, chunk: int, low: int, high: int, most: int) -> DataFrame:
    """Ungapped search for a mate in the window low..high behind its anchor.

    ``anchors`` (bead_id, contig, pos), ``mates`` (bead_id, colors), ``chunks`` (contig,
    chunk_start, colors) starting at multiples of ``chunk`` and overlapping by a read
    length or more.  Each anchor meets the chunks its window touches; every position of
    the window is owned by one chunk.  Returns placements with the fewest mismatches,
    at most ``most``.  All rows of a slab go through one numpy operation a colour.
    """

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for rows, mate, ref, first, count in _slabs(frame, chunk, low, high, 0):
                places = ref.shape[1] - mate.shape[1] + 1
                mm = np.zeros((len(rows), places), np.int32)
                for i in range(mate.shape[1]):
                    mm += (ref[:, i : i + places] != mate[:, i : i + 1]) | (mate[:, i : i + 1] == NO)
                r, p = np.nonzero((mm <= most) & (np.arange(places) < count[:, None]))
                yield pd.DataFrame({"bead_id": rows["bead_id"].to_numpy()[r], "contig": rows["contig"].to_numpy()[r], "pos": first[r] + p, "mm": mm[r, p]})

    kind = anchors.schema["bead_id"].dataType.simpleString()
    rows = _probes(anchors, mates, chunks, chunk, low, high)
    return best_by_mismatch(rows.mapInPandas(search, f"bead_id {kind}, contig string, pos bigint, mm int"), ["bead_id"])


def rescue_indel(anchors: DataFrame, mates: DataFrame, chunks: DataFrame, chunk: int, low: int, high: int, longest: int, most: int, limit: int | None = None) -> DataFrame:
    """Search for a mate with exactly one indel of up to ``longest`` bases, in the window of ``rescue``.

    (bead_id, contig, pos, size, cut, mm): ``cut`` colours in front of the indel, positive
    sizes for reference bases that the read lacks; a place's best split (fewest mismatches,
    then the shortest indel, deletions first, then the smallest cut).  Chunks overlap by a
    read length and ``longest`` or more.  Each bead keeps its placements with the fewest
    mismatches, at most ``limit`` of them (shortest indel, contig, place) where that is set.
    """

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for rows, mate, ref, first, count in _slabs(frame, chunk, low, high, longest):
                mm, size, cut = indel_scan(mate, ref, longest)
                r, p = np.nonzero((size != 0) & (mm <= most) & (np.arange(mm.shape[1]) < count[:, None]))
                yield pd.DataFrame({"bead_id": rows["bead_id"].to_numpy()[r], "contig": rows["contig"].to_numpy()[r], "pos": first[r] + p, "size": size[r, p], "cut": cut[r, p], "mm": mm[r, p]})

    kind = anchors.schema["bead_id"].dataType.simpleString()
    found = best_by_mismatch(_probes(anchors, mates, chunks, chunk, low, high).mapInPandas(search, f"bead_id {kind}, contig string, pos bigint, size int, cut int, mm int"), ["bead_id"])
    if limit is None:
        return found
    order = Window.partitionBy("bead_id").orderBy(F.abs("size"), "contig", "pos", F.desc("size"))
    return found.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= limit).drop("_rank")


INDEL = r"^([^,]+),(\d+)_(-?\d+)(?:\.\d+)?\|(\d+)_(-?\d+)\.(\d+)\.(\d+)\((\d+),(\d+)_(\d+)\)$"


def parse_indels(lines: DataFrame, column: str = "value") -> DataFrame:
    """Indel records of rescued pairs: exactly one ``|`` and a bracket; size = covered length - 1 - matched."""
    c = F.col(column)
    part = lambda i: F.regexp_extract(c, INDEL, i)
    rows = lines.where(c.rlike(r"^[^|]*\|[^|]*$") & c.contains("(") & c.rlike(INDEL))
    pos, length = part(5).cast("bigint"), part(6).cast("int")
    size = F.lit(0) + part(9).cast("int") + part(10).cast("int") - length + 1
    return rows.select(part(1).alias("bead_id"), part(4).cast("int").alias("contig"), F.when(pos < 0, -pos - part(8).cast("int")).otherwise(pos + part(8).cast("int")).alias("pos"), size.alias("size"), part(7).cast("int").alias("mm"), F.abs(part(3).cast("bigint")).alias("r_pos"), F.abs(pos).alias("f_pos"))


def indel_clusters(records: DataFrame, reach: int = 2, members: int = 5, zone: int = 1 << 20) -> DataFrame:
    """Clusters of indels (contig, pos, size, r_pos, f_pos, bead_id): one opens where a position lies more than ``reach`` beyond the one that opened the last.

    A gap of more than ``reach`` between neighbours always opens a cluster, whatever
    came before; so stretches between such gaps are independent and each, not each
    contig, is one group of the stateful pass.
    """
    from .intervals import cluster, contained_join

    stretches = cluster(records.select("contig", F.col("pos").alias("_a"), F.col("pos").alias("_b")), ["contig"], "_a", "_b", gap=reach, block=zone)

    tagged = contained_join(records.withColumn("_p", F.col("pos")), stretches.select("contig", F.col("start").alias("_s"), F.col("end").alias("_e")), ["contig"], ("pos", "_p", "_s", "_e")).drop("_p", "_e")

    def split(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["pos", "bead_id"], kind="stable")
        out, anchor, rows = [], None, []

        def close():
            if rows:
                pairs = {(r.r_pos, r.f_pos) for r in rows}
                out.append((rows[0].contig, anchor, max(r.pos for r in rows), len(pairs), len(rows), min(r.size for r in rows), max(r.size for r in rows), [str(r.bead_id) for r in rows[:members]]))

        for row in frame.itertuples(index=False):
            if anchor is None or row.pos > anchor + reach:
                close()
                anchor, rows = row.pos, []
            rows.append(row)
        close()
        return pd.DataFrame(out, columns=["contig", "start", "end", "n_unique", "n_total", "min_size", "max_size", "members"])

    kind = records.schema["contig"].dataType.simpleString()
    return tagged.groupBy("contig", "_s").applyInPandas(split, f"contig {kind}, start bigint, end bigint, n_unique bigint, n_total bigint, min_size bigint, max_size bigint, members array<string>")
