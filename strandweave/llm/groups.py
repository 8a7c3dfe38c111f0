"""Whole groups in Arrow streams, and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import materialise

CHUNK = 4_000_000
_WAYS = "explode(array(struct(u, v), struct(v AS u, u AS v))) AS x"
_EDGES = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def whole_groups(batches, key: str) -> Iterator[pa.Table]:
    """Tables of whole groups from batches that are sorted by ``key``."""
    rest = []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        if rest and rest[-1].column(batch.schema.get_field_index(key))[-1].as_py() == k[-1] and k[0] == k[-1]:
            rest.append(batch)
            continue
        cut = int(np.flatnonzero(k != k[-1])[-1]) + 1 if (k != k[-1]).any() else 0
        rest.append(batch.slice(0, cut))
        done = pa.Table.from_batches(rest)
        if done.num_rows:
            yield done
        rest = [batch.slice(cut)]
    if rest:
        yield pa.Table.from_batches(rest)


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the groups of a and b in ``label``, where every member has its group's least member."""
    while True:
        a, b = label[a], label[b]
        apart = a != b
        a, b = a[apart], b[apart]
        if not len(a):
            return
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            short = label[label]
            if (short == label).all():
                break
            label[:] = short


def _contract(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    """Edges (node, least node of its group) instead of (node, neighbour) ones, both ways round, of the nodes u; edges that a neighbour's own task sends are left to it."""
    names, ids = np.unique(np.r_[u, v], return_inverse=True)
    a, b = ids[: len(u)], ids[len(u) :]
    label = np.arange(len(names))
    unite(label, a, b)
    send = label != np.arange(len(names))
    own = np.zeros(len(names), bool)
    own[a] = True
    known = label[b] == a  # the root has this edge, and so the node's own task has it, too
    there = np.zeros(len(names), bool)
    there[b[known]] = True
    send &= own | ~there
    return pa.RecordBatch.from_arrays([pa.array(names[send]), pa.array(names[label[send]])], schema=_EDGES)


def _contracted(batches):
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= CHUNK:
            table = pa.Table.from_batches(held)
            u, v = (table.column(i).to_numpy() for i in (0, 1))
            cut = int(np.searchsorted(u, u[-1]))  # the last node's edges may go on
            cut = cut or len(u)
            yield _contract(u[:cut], v[:cut])
            held = table.slice(cut).combine_chunks().to_batches()
            size = table.num_rows - cut
    if size:
        table = pa.Table.from_batches(held)
        yield _contract(*(table.column(i).to_numpy() for i in (0, 1)))


def _round(edges: DataFrame, seen: Observation | None = None) -> DataFrame:
    """Each node's edges meet in one task, which joins all that it holds to groups and sends an edge from each node to its group's least one."""
    both = edges.selectExpr(_WAYS).select("x.u", "x.v").repartition(F.col("u")).sortWithinPartitions("u")
    after = both.mapInArrow(_contracted, "u bigint, v bigint")
    if seen is not None:
        after = after.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum"))
    return materialise(after, "components")


def components(edges: DataFrame, a: str = "cls", b: str = "other") -> DataFrame:
    """(node, comp): the least node of each connected component, for all nodes that have an edge to another.

    Two rounds of contraction leave most nodes with one edge, to their root; these
    are set aside.  The others go on until no edge changes: a node's least known
    root never rises, and ends as its component's least node.  Each round is written
    to the shared folder, with its number of edges and the sum of their hashes, by
    which rounds are compared.
    """
    now = _round(_round(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")))
    degree = now.selectExpr(_WAYS).groupBy(F.col("x.u").alias("u")).agg(F.count(F.lit(1)).alias("n"))
    now = materialise(now.join(degree, "u"), "components")
    rest, core, before = now.where("n = 1").select("u", "v"), now.where("n > 1").select("u", "v"), None
    while True:
        seen = Observation()
        core = _round(core, seen)
        if seen.get == before:
            break
        before = seen.get
    roots = core.select(F.col("u").alias("v"), F.col("v").alias("root"))
    out = rest.join(roots, "v", "left").select(F.col("u").alias("node"), F.coalesce("root", "v").alias("comp")).unionByName(core.toDF("node", "comp"))
    out = materialise(out, "components")
    return out.unionByName(out.select(F.col("comp").alias("node"), "comp").distinct())
