"""Operators that the registered queries don't reach, and plans that must hold at scale."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandweave.functions import stats
from strandweave.functions.mask import ReadMask
from strandweave.operators import alignments as al
from strandweave.operators import mapping, ntr
from strandweave.operators.extension import rescore
from strandweave.settings import layered
from strandweave.sources import readers, store
from strandweave.streaming import hits as streaming


def test_pieces_and_slices(spark):
    text = "".join("ACGT"[i * i % 4] for i in range(1000)) + "G"
    df = spark.createDataFrame([(1, text), (2, "ACG"), (3, ""), (4, None), (5, text[:64]), (6, text[:70])], "k int, seq string")
    for k in (3, 8, 100):
        got = {(r.k, r.at, r.s) for r in mapping.slices(df, "seq", k, "s", "at").collect()}
        assert got == {(r.k, i, r.seq[i : i + k]) for r in df.collect() for i in range(len(r.seq or "") - k + 1)}
    rows = df.select("k", F.explode(mapping.pieces(F.col("seq"), 10, 25)).alias("p")).where("k = 1").collect()
    assert [r.p for r in rows] == [text[i : i + 35] for i in range(0, len(text), 10)]


def test_small_reads_broadcast(spark):
    reads = spark.createDataFrame([("r", "A", "0123012301230123012301230")], "read_id string, primer string, colors string")
    contigs = spark.createDataFrame([("c", "ACGT" * 100)], "contig string, seq string")
    plan = mapping.map_reads(reads, contigs, 25, 2)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_random_statistics_as_columns(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0, 4.0, 5.0], [2.0, 4.0, 6.1, 8.0, 10.0], 30, 10), (2, [1.0, 2.0, 3.0, 4.0, 5.0], [3.0, 1.0, 2.0, 5.0, 1.0], 5, 5)], "k int, x array<double>, y array<double>, a int, b int")
    got = df.select("k", stats.permutation_ps(F.col("x"), F.col("y"), 500).alias("p"), stats.redistributed(F.col("a"), F.col("b"), 0.5, F.col("k")).alias("d")).orderBy("k").collect()
    assert got[0].p < 0.1 < got[1].p and got[0].d.first + got[0].d.second == 40
    again = df.select(stats.redistributed(F.col("a"), F.col("b"), 0.5, F.col("k")).alias("d")).collect()
    assert [r.d for r in again] == [r.d for r in got]


def test_masks_agree(spark):
    df = spark.createDataFrame([("0123" * 12,)], "colors string")
    for text in ("", "33", "33..", "1-5,9,33..", "5-1", "1011"):
        mask = ReadMask(text)
        want = "".join(c if b == "1" else "." for c, b in zip("0123" * 12, mask.bits(48), strict=True))
        assert df.select(mask.apply(F.col("colors")).alias("m")).first().m == want


def test_means_and_costs(spark):
    parts = spark.createDataFrame([("a", 2.0, 1), ("a", 5.0, 3)], "k string, mean double, n long")
    assert ntr.merge_means(parts, ["k"], "mean", "n").first()["mean"] == 4.25
    rows = spark.createDataFrame([("0123", "0023", [30, 3, 0, 9])], "read_colors string, ref_colors string, quality array<int>")
    assert rescore(rows).first().cost == round(10 * (1 - 10**-0.3))


def test_provenance_keeps_every_key(spark, tmp_path):
    path = tmp_path / "p.txt"
    path.write_text("".join(f"#k{i}={i}\n" for i in range(12_000)))
    assert len(readers.provenance(spark, str(path))) == 12_000


def test_streamed_hits(spark, tmp_path):
    hits = spark.createDataFrame([(i // 2, "c", i, "+", 30 - i % 2) for i in range(20)], "read_id long, contig string, start0 long, strand string, score int")
    hits.write.parquet(f"{tmp_path}/in")
    stream = streaming.stream_hits(spark, f"{tmp_path}/in", hits.schema)
    streaming.apply_batches(stream, lambda b: al.select_hits(b, "top_score"), f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
    assert sorted(r.start0 for r in spark.read.parquet(f"{tmp_path}/out").collect()) == list(range(0, 20, 2))


def test_reference_order(spark):
    rows = [(f"r{i}", "c" + str(i % 3), int(x), "+") for i, x in enumerate(np.random.default_rng(1).integers(0, 1000, 500))]
    df = al.in_reference_order(spark.createDataFrame(rows, "read_id string, contig string, start0 long, strand string"))
    got = [(r.contig, r.start0, r.strand, r.read_id) for r in df.collect()]
    assert got == sorted(got)


def test_reference_store(spark, tmp_path):
    text = "".join("ACGT"[i * i * 7 % 4] for i in range(1000))
    df = spark.createDataFrame([("a", text), ("b", text[::-1])], "contig string, seq string")
    store.write_reference(df, f"{tmp_path}/ref", 64)
    for at, n in ((0, 10), (60, 10), (63, 200), (990, 50)):
        assert [r.seq for r in store.read_span(spark, f"{tmp_path}/ref", "a", at, n, 64).collect()] == [text[at : at + n]]
    assert store.read_span(spark, f"{tmp_path}/ref", "a", 5000, 5, 64).count() == 0
    plan = spark.read.parquet(f"{tmp_path}/ref").where("contig = 'a' and chunk_start > 5")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(contig,a)" in plan and "GreaterThan(chunk_start,5)" in plan


def test_layered_settings(tmp_path):
    (tmp_path / "a.ini").write_text("x = 2\ny = b\n")
    (tmp_path / "b.ini").write_text("y = c\n")
    files = [str(tmp_path / n) for n in ("a.ini", "b.ini", "none.ini")]
    assert layered({"x": "1", "y": "a", "z": "9"}, files, {"z": "8"}, {"x": int}) == {"x": 2, "y": "c", "z": "8"}
    with pytest.raises(ValueError, match="unknown settings: w"):
        layered({"x": "1"}, (), {"w": "1"})
    with pytest.raises(ValueError, match="x: "):
        layered({"x": "one"}, checks={"x": int})


def test_many_seeds_stay_out_of_the_driver(spark, monkeypatch):
    from strandweave.operators import mapping, merging

    contigs = spark.createDataFrame([("c", "ACGTTGCAAGGCTTAACCGGATATTCGCGA")], "contig string, seq string")
    reads = spark.createDataFrame([(1, "A", "13101310202")], "read_id int, primer string, colors string")
    texts = spark.createDataFrame([(1, "TTGCAAGG")], "read_id int, seq string")
    few = [sorted(mapping.map_reads(reads, contigs, 10, 1).collect()), sorted(merging.sequence_matches(texts, contigs, 8, 1).collect())]
    monkeypatch.setattr(mapping, "MOST_SENT", 0)
    for want, got in zip(few, [mapping.map_reads(reads, contigs, 10, 1), merging.sequence_matches(texts, contigs, 8, 1)], strict=True):
        assert sorted(got.collect()) == want and want
        assert "BroadcastHashJoin" not in got._jdf.queryExecution().executedPlan().toString()


def test_seed_masks_are_complete():
    from itertools import combinations

    for n, most in ((12, 2), (40, 1), (33, 3), (5, 0), (3, 2), (2, 1)):
        masks = mapping.seed_masks(n, most)
        wide = [min(31, n - a) for a in range(0, n, 31)]
        for wrong in combinations(range(n), most):
            hit = [sum(3 << 2 * (w - 1 - i % 31) for i in wrong if i // 31 == k) for k, w in enumerate(wide)]
            assert any(all(a & b == 0 for a, b in zip(hit, mask, strict=True)) for mask in masks), (n, most, wrong)


@pytest.mark.parametrize(("length", "most", "adjacent"), [(26, 2, False), (26, 2, True), (40, 3, False), (10, 1, True)])
def test_many_reads_map_as_few(spark, monkeypatch, length, most, adjacent):
    rng = np.random.default_rng(length)
    base = ["".join(rng.choice(list("ACGT"), 120)) for _ in range(3)]
    contigs = [*((f"c{i}", x) for i, x in enumerate(base)), ("copy", base[0]), ("part", base[0][7:]), ("n", base[1][:50] + "N" + base[1][51:]), ("barrier", base[2][:60] + "." + base[2][61:]), ("short", "ACG"), ("none", None)]
    reads = []
    for k in range(40):
        x, at = base[k % 3], int(rng.integers(0, 118 - length))
        c = ["ACGT".index(a) ^ "ACGT".index(b) for a, b in zip(x[at:], x[at + 1 : at + length + 1])]
        c = [str(v) for v in (c[::-1] if k % 4 == 0 else c)]
        for i in rng.integers(1, length, int(rng.integers(0, most + 2))):
            c[i] = "0123.5"[int(rng.integers(0, 6))]
        reads.append((f"r{k}", "ACGTN"[k % 5] if k % 4 == 0 else x[at], "".join(c)))
    reads += [("same", *reads[1][1:]), ("same", *reads[1][1:]), ("short", "A", "0")]
    reads = spark.createDataFrame(reads, "read_id string, primer string, colors string")
    got = []
    for rows, limit in ((contigs, 1 << 17), (contigs, 0), ([*contigs, contigs[0]], 1 << 17), ([*contigs, contigs[0]], 0)):
        monkeypatch.setattr(mapping, "MOST_SENT", limit)
        got.append(sorted(mapping.map_reads(reads, spark.createDataFrame(rows, "contig string, seq string"), length, most, adjacent).collect()))
    assert got[0] and got[0] == got[1] == got[2] == got[3]
    assert {r.strand for r in got[0]} == {"+", "-"} and {r.mm for r in got[0]} >= {0, 1}


def test_copies_do_not_multiply_candidates(spark, monkeypatch):
    def joined(plan):
        name = plan.nodeName()
        inner = [plan.executedPlan()] if name == "AdaptiveSparkPlan" else [plan.plan()] if "QueryStage" in name else [plan.children().apply(i) for i in range(plan.children().size())]
        own = plan.metrics().apply("numOutputRows").value() if name == "SortMergeJoin" else 0
        return own + sum(map(joined, inner))

    text = "ACGTTGCAAGGCTTAACCGGATATTCGCGATTAC"
    colors = "".join(str("ACGT".index(a) ^ "ACGT".index(b)) for a, b in zip(text, text[1:]))[:27]
    reads = spark.createDataFrame([(i, "A", colors) for i in range(120)], "read_id int, primer string, colors string")
    contigs = spark.createDataFrame([(f"c{i}", text) for i in range(120)], "contig string, seq string")
    written, cut = [], mapping.cut
    monkeypatch.setattr(mapping, "cut", lambda df: written.append(cut(df)) or written[-1])
    monkeypatch.setattr(mapping, "MOST_SENT", 0)
    monkeypatch.setattr(mapping, "LISTS", 4, raising=False)
    got = mapping.map_reads(reads, contigs, 26, 2)
    assert len({(r.read_id, r.contig) for r in got.collect()}) == 120 * 120
    assert max([joined(got._jdf.queryExecution().executedPlan()), *(t.count() for t in written)]) < 120 * 120
