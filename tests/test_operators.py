import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandweave.lineage import cut
from strandweave.operators import alignments, assembly, counting, coverage, extension, intervals, junctions, mapping, ntr, pairs, seeds, simulate, variants


def letters(seed, alphabet, n):
    draw = random.Random(seed)
    return "".join(draw.choice(alphabet) for _ in range(n))


def intervals_of(draw, n, top, longest):
    return [(i, draw.choice("AB"), s := draw.randrange(top), s + draw.randrange(longest)) for i in range(n)]


def test_binned_join_equals_nested_loop(spark):
    draw = random.Random(2)
    a, b = intervals_of(draw, 60, 3000, 700), intervals_of(draw, 60, 3000, 700)
    left = spark.createDataFrame(a, "i int, c string, s1 int, e1 int")
    right = spark.createDataFrame(b, "j int, c string, s2 int, e2 int")
    want = {(x[0], y[0]) for x in a for y in b if x[1] == y[1] and x[2] <= y[3] and y[2] <= x[3]}
    pairs_ = intervals.interval_join(left, right, ["c"], ("s1", "e1", "s2", "e2"), width=128).select("i", "j").collect()
    assert sorted(map(tuple, pairs_)) == sorted(want)
    inside = intervals.contained_join(left, right, ["c"], ("s1", "e1", "s2", "e2"), 3, 5, width=128).select("i", "j").collect()
    assert sorted(map(tuple, inside)) == sorted((x[0], y[0]) for x in a for y in b if x[1] == y[1] and x[2] >= y[2] - 3 and x[3] <= y[3] + 5)
    semi = intervals.interval_join(left, right, ["c"], ("s1", "e1", "s2", "e2"), width=128, how="left_anti")
    assert {r.i for r in semi.collect()} == {x[0] for x in a} - {i for i, _ in want}


def test_clusters_follow_the_rule_of_touching(spark):
    rows = [("A", "+", 10, 60), ("A", "+", 55, 90), ("A", "+", 5, 12), ("A", "+", 91, 120), ("A", "-", 10, 60), ("B", "+", 10, 60)]
    df = spark.createDataFrame(rows, "contig string, strand string, s int, e int")
    for block in (8, 1 << 16):
        got = sorted((r.contig, r.strand, r.start, r.end, r.n) for r in intervals.cluster(df, ["contig", "strand"], "s", "e", block=block).collect())
        assert got == [("A", "+", 5, 90, 3), ("A", "+", 91, 120, 1), ("A", "-", 10, 60, 1), ("B", "+", 10, 60, 1)]


def test_nearest_equals_brute_force(spark):
    draw = random.Random(4)
    points = [(i, draw.choice("AB"), draw.randrange(400)) for i in range(40)]
    marks = [(draw.choice("AB"), s := draw.randrange(400), s + draw.randrange(30)) for _ in range(25)]
    p, m = spark.createDataFrame(points, "i int, c string, p bigint"), spark.createDataFrame(marks, "c string, s bigint, e bigint")
    for side, block in itertools.product(("left", "right"), (16, 1 << 16)):
        got = {r.i: r.distance for r in intervals.nearest(p, m, ["c"], "p", "s", "e", side, block).collect()}
        for i, c, at in points:
            gaps = [at - e for k, _, e in marks if k == c and e < at] if side == "left" else [s - at for k, s, _ in marks if k == c and s > at]
            assert got[i] == min(gaps, default=None)


def dense(rows):
    out = {}
    for c, s, e in rows:
        for p in range(s, e + 1):
            out[c, p] = out.get((c, p), 0) + 1
    return out


def test_coverage_and_windows_equal_dense_form(spark):
    draw = random.Random(6)
    rows = [(draw.choice("AB"), s := draw.randrange(300), s + draw.randrange(1, 25)) for _ in range(80)]
    df = spark.createDataFrame([(c, "+", s, e) for c, s, e in rows], "contig string, strand string, start0 bigint, end0 bigint")
    runs = cut(coverage.coverage(df, ["contig", "strand"], block=32))
    depth = dense(rows)
    got = {(r.contig, p): r.depth for r in runs.collect() for p in range(r.start0, r.end0_excl)}
    assert got == depth
    for w, t in ((5, 3), (20, 2)):
        want = set()
        for c in "AB":
            hot = [p for p in range(400) if sum(depth.get((c, q), 0) for q in range(p - w + 1, p + 1)) >= t * w]
            for _, g in itertools.groupby(enumerate(hot), lambda x: x[1] - x[0]):
                g = list(g)
                want.add((c, g[0][1] - w + 1, g[-1][1]))
        found = {(r.contig, r.start0, r.end0) for r in ntr.sweep(runs, [w], [t]).collect()}
        assert found == want
    high = {(r.contig, r.start0, r.end0_excl) for r in coverage.above(runs, ["contig", "strand"], 3, 32).collect()}
    assert {(c, p) for c, a, b in high for p in range(a, b)} == {k for k, v in depth.items() if v >= 3}


HITS = "read_id int, contig string, strand string, start0 bigint, aln_len int, score int, mm int"


def test_uniqueness_and_modes(spark):
    rows = [(1, "A", "+", 5, 25, 20, 0), (1, "A", "+", 9, 25, 12, 1), (2, "A", "+", 5, 25, 20, 0), (2, "A", "-", 5, 25, 20, 0), (3, "B", "+", 1, 25, 12, 0)]
    df = spark.createDataFrame(rows, HITS)
    best = {r.read_id: (r.start0, r.n_hits) for r in alignments.unique_best(df, 4, 9).collect()}
    assert best == {1: (5, 2), 3: (1, 1)}  # equal hits on both strands are two hits
    assert {r.read_id for r in alignments.unique_best(df, 4, 10).collect()} == {1}  # a lone hit below the bar
    top = sorted((r.read_id, r.strand) for r in alignments.select_hits(df, "top_score").collect())
    assert top == [(1, "+"), (2, "+"), (2, "-"), (3, "+")]
    picked = alignments.select_hits(df, "random", seed=3)
    assert sorted(r.read_id for r in picked.collect()) == [1, 2, 3]
    several = spark.range(400).selectExpr("cast(id % 200 as int) read_id", "'A' contig", "'+' strand", "id div 200 start0", "25 aln_len", "20 score", "0 mm")
    assert {r.start0 for r in alignments.select_hits(several, "random").collect()} == {0, 1}  # the last hit can be chosen
    assert [r.read_id for r in alignments.select_hits(df, "unique").collect()] == [3]
    with pytest.raises(ValueError):
        alignments.select_hits(df, "other")


def test_contaminant_modes(spark):
    df = spark.createDataFrame([(1, True), (1, False), (2, True), (2, True), (3, False)], "read_id int, is_filtered boolean")
    get = lambda m: sorted(r.read_id for r in alignments.contamination(df, m).collect())
    assert (get("off"), get("one"), get("both")) == ([1, 2, 3], [3], [1, 3])


def test_containment_is_found_from_an_earlier_bin(spark):
    a = spark.createDataFrame([("A", "+", 98, 110), ("A", "-", 98, 110), ("A", "+", 90, 110)], "contig string, strand string, start0 bigint, end0 bigint")
    f = spark.createDataFrame([(1, "A", "+", 102, 120), (2, "A", ".", 102, 120), (3, "B", "+", 1, 5)], "feature_id int, contig string, f_strand string, start1 bigint, end1 bigint")
    got = {r.feature_id: r.n_reads for r in counting.contained_counts(a, f, width=50).collect()}
    assert got == {1: 1, 2: 2, 3: 0}


REF = "CGAGCATTAACGTTTCCGGGTATT.ACCACAACGGCGAGCATTAACGTTTCCGGGTAGGCA.AGCATTAACGTT"
REF_N = REF.replace("CATTAACG", "CATTANCG", 1)
CASES = {
    "T23223130301310020300": (["0.0", "35.0"], ["0.2", "35.0"]), "T20030200131030313223": (["-19.0", "-54.0"], ["-19.2", "-54.0"]), "T23223131301310020300": (["0.1", "35.1"], ["35.1"]),
    "T23223230301310120300": (["0.2", "35.2"], ["35.2"]), "T23220130311310030300": ([], []), "T23223130302010020300": (["0.2", "35.2"], ["35.2"]), "T33223130301310020300": (["0.1", "35.1"], ["35.1"]),
    "T23223130.01310020300": (["0.1", "35.1"], ["35.1"]), "A13223130301310020300": (["0.0", "35.0"], ["0.2", "35.0"]), "T30130332231303013100": (["30.0"], ["30.0"]),
}


@pytest.mark.parametrize("which", [0, 1])
def test_mapping_fixtures(spark, which):
    reads = spark.createDataFrame([(b, b[0], b[1:]) for b in CASES], "read_id string, primer string, colors string")
    ref = spark.createDataFrame([("ref", (REF, REF_N)[which])], "contig string, seq string")
    for chunk in (16, 1024):
        hits = mapping.map_reads(reads, ref, 20, 2, chunk=chunk)
        got = {b: set() for b in CASES}
        for r in hits.select("read_id", "mm", mapping.signed_position(F.col("pos0"), F.col("strand"), 20).alias("p")).collect():
            got[r.read_id].add(f"{r.p}.{r.mm}")
        assert got == {b: set(v[which]) for b, v in CASES.items()}


def test_mapping_equals_brute_force(spark):
    draw = random.Random(8)
    contigs = [("a", "".join(draw.choice("ACGT") for _ in range(300))), ("b", "".join(draw.choice("ACGT") for _ in range(200)))]
    sim = simulate.simulate(spark, contigs, 60, 15, error=0.1, seed=2).select("read_id", "primer", "colors")
    hits = mapping.map_reads(sim, spark.createDataFrame(contigs, "contig string, seq string"), 15, 2)
    got = {(r.read_id, r.contig, r.pos0, r.strand): r.mm for r in hits.collect()}
    code, want = {b: i for i, b in enumerate("ACGT")}, {}
    for r in sim.collect():
        first = "ACGT"[code[r.primer] ^ int(r.colors[0])]
        for name, seq in contigs:
            for p in range(len(seq) - 14):
                window = seq[p : p + 15]
                for strand, s in (("+", window), ("-", simulate.reverse_complement(window))):
                    mm = sum(x != y for x, y in zip(simulate.colors_of(s), r.colors[1:15], strict=True)) + (s[0] != first)
                    if mm <= 2:
                        want[r.read_id, name, p, strand] = mm
    assert got == want and want


def walk(read, ref, mask, match, mismatch, adjacent, backward):
    """The rule, one position at a time."""
    best = score = mm = best_mm = length = run = pairs_ = 0
    order = range(len(read) - 1, -1, -1) if backward else range(len(read))
    for n, i in enumerate(order):
        if mask[i]:
            if read[i] == ref[i]:
                score, run = score + match, 0
            else:
                score, mm, run = score + mismatch, mm + 1, run + 1
                j = i + 1 if backward else i - 1
                if run > 1 and int(read[i]) ^ int(read[j]) == int(ref[i]) ^ int(ref[j]):
                    pairs_ += 1
                    if adjacent:
                        score, mm, run = score - mismatch + match, mm - 1, 0
        else:
            run = 0
        if score > best:
            best, best_mm, length = score, mm, n + 1
    return best, length, best_mm, pairs_


def test_extension_equals_walk():
    draw = random.Random(3)
    for backward, adjacent in itertools.product((False, True), repeat=2):
        refs = ["".join(draw.choice("0123") for _ in range(30)) for _ in range(200)]
        reads = ["".join(c if draw.random() > 0.3 else draw.choice("0123") for c in r) for r in refs]
        mask = np.array([draw.random() > 0.1 for _ in range(30)])
        a, n = extension.color_array(reads)
        b, _ = extension.color_array(refs)
        found = extension.extend(a, b, n, mask, 1, -1, adjacent, backward)
        for i, (x, y) in enumerate(zip(reads, refs, strict=True)):
            assert tuple(int(found[k][i]) for k in ("score", "aln_len", "mm", "n_pairs")) == walk(x, y, mask, 1, -1, adjacent, backward)


def test_junctions(spark):
    exons = spark.createDataFrame([("c", "+", "g", "t1", 1, 10), ("c", "+", "g", "t1", 21, 30), ("c", "+", "g", "t1", 41, 50), ("c", "+", "g", "t2", 1, 10), ("c", "+", "g", "t2", 41, 50)], "contig string, strand string, gene_id string, transcript_id string, start1 bigint, end1 bigint")
    known = junctions.known(exons, 4)
    ends = lambda df: sorted((r.left_start1, r.left_end1, r.right_start1, r.right_end1) for r in df.collect())
    assert ends(known) == [(7, 10, 21, 24), (7, 10, 41, 44), (27, 30, 41, 44)]
    assert ends(junctions.putative(exons.where("transcript_id = 't1'"), junctions.known(exons.where("transcript_id = 't1'"), 4), 4)) == [(7, 10, 41, 44)]
    seq = letters(1, "ACGT", 60)
    chunks = mapping.chunk_reference(spark.createDataFrame([("c", seq)], "contig string, seq string"), 16, 8)
    got = {(r.left_end1, r.right_start1): r.seq for r in junctions.sequences(known, chunks, 16).collect()}
    assert got[10, 21] == seq[6:10] + seq[20:24]


def test_pairs_and_indels(spark):
    r = spark.createDataFrame([(1, "A", "+", 100, 25, 0, 25), (2, "A", "+", 100, 25, 0, 25), (3, "A", "+", 1, 25, 0, 25), (4, "A", "+", 1, 25, 0, 25)], "bead_id int, contig string, strand string, pos bigint, len int, mm int, score int")
    f = spark.createDataFrame([(1, "A", "+", 200, 25, 0, 25), (2, "A", "-", 200, 25, 0, 25), (3, "B", "+", 1, 25, 0, 25), (5, "A", "+", 1, 25, 0, 25)], r.schema)
    assert [(x.bead_id, x.distance) for x in pairs.pair_band(r, f, 50, 150).collect()] == [(1, 125)]
    assert {x.bead_id: x["class"] for x in pairs.pair_classes(r, f, 50, 150).collect()} == {1: "good", 2: "strand", 3: "contig", 4: "r_only", 5: "f_only"}
    rows = [("A", p, -1, p, p + 1, str(i)) for i, p in enumerate([10, 12, 13, 14, 30])]
    df = spark.createDataFrame(rows, "contig string, pos bigint, size int, r_pos bigint, f_pos bigint, bead_id string")
    got = sorted((x.start, x.end, x.n_total) for x in pairs.indel_clusters(df).collect())
    assert got == [(10, 12, 2), (13, 14, 2), (30, 30, 1)]  # by anchor, not by chain; the last cluster is there
    line = spark.createDataFrame([("7_40_12_R3,2_5000.0|2_6200.28.1(12,11_13)",), ("no indel",)], "value string")
    x = pairs.parse_indels(line).first()
    assert (x.bead_id, x.contig, x.pos, x.size) == ("7_40_12_R3", 2, 6212, -3)


def test_rescue(spark):
    seq = letters(5, "0123", 200)
    chunks = spark.createDataFrame([("A", i, seq[i : i + 48]) for i in range(0, 200, 32)], "contig string, chunk_start bigint, colors string")
    anchors = spark.createDataFrame([(1, "A", 10)], "bead_id bigint, contig string, pos bigint")
    mates = spark.createDataFrame([(1, seq[90:105])], "bead_id bigint, colors string")
    assert [(r.pos, r.mm) for r in pairs.rescue(anchors, mates, chunks, 32, 40, 120, 1).collect()] == [(90, 0)]


def test_variants(spark):
    c = spark.createDataFrame([("A", 100, 1), ("A", 120, 2)], "contig string, pos bigint, id int")
    k = spark.createDataFrame([("A", 91), ("A", 109), ("A", 110), ("A", 130)], "contig string, known_pos bigint")
    assert [(r.id, r.known_pos) for r in variants.near_known(c, k, 10, ["id"]).collect()] == [(1, 91)]
    tx = spark.createDataFrame([("A", "+", "t", 10, 60, 15, 55)], "contig string, strand string, transcript_id string, tx_start0 bigint, tx_end0 bigint, cds_start0 bigint, cds_end0 bigint")
    ex = spark.createDataFrame([("A", "+", "t", 10, 20, 15, 55), ("A", "+", "t", 40, 60, 15, 55)], "contig string, strand string, transcript_id string, start0 bigint, end0 bigint, cds_start0 bigint, cds_end0 bigint")
    at = spark.createDataFrame([("A", p) for p in (5, 12, 16, 25, 30, 41, 58)], "contig string, pos0 bigint")
    got = {r.pos0: (r.place, r.codon_no, r.codon_pos, r.near_splice) for r in variants.annotate_positions(at, ex, tx).collect()}
    assert got == {5: ("intergenic", None, None, False), 12: ("5'utr", None, None, False), 16: ("coding", 0, 1, False), 25: ("intronic", None, None, True), 30: ("intronic", None, None, False), 41: ("coding", 2, 1, False), 58: ("3'utr", None, None, False)}


def test_assembly_consensus_edits():
    text = "ACGTTGCAAGGCTTACCGATCGGATTACA"
    assert assembly.assemble([text[i : i + 12] for i in range(0, 18, 3)], 6) == text[:27]
    colors = simulate.colors_of(text)
    noisy = colors[:10] + str((int(colors[10]) + 1) % 4) + colors[11:]
    assert assembly.consensus(len(text), [(0, colors), (0, colors), (0, noisy)], "A") == text
    assert assembly.consensus(6, [(0, "11")], "A")[3:] == "NNN"
    assert assembly.apply_edits("ACGTACGT", [(1, "R", "T"), (3, "I", "GG"), (5, "D", "CG")]) == "ATGGGTAT"


def test_seed_design():
    for most in (1, 2):
        masks = seeds.block_masks(12, most, most + 1)
        assert seeds.complete(masks, 12, most) and not seeds.complete(masks[:1], 12, most)
    pairs_ = seeds.adjacent_masks(12, 1)
    assert seeds.complete(pairs_, 12, 1, adjacent=True)
    small = seeds.smallest(seeds.block_masks(12, 1, 4), 12, 1)
    assert seeds.complete(small, 12, 1) and len(small) <= 4
    assert all(m.count("1") <= 4 for m in seeds.at_most_ones(masks, 4))


def test_kernels():
    assert extension.banded("ACGT", "TTACGTTT", 6)[0] == 4 - 2 * 2 or extension.banded("ACGT", "ACGTTT", 2)[0] == 4
    ref = letters(9, "0123", 40)
    # two bases lost: the colours over the gap merge into their exclusive or
    cut = 15
    merged = str(int(ref[cut]) ^ int(ref[cut + 1]) ^ int(ref[cut + 2]))
    read = ref[:cut] + merged + ref[cut + 3 :][:14]
    found = extension.one_indel(read, ref, 3)
    assert found is not None and found[1] == 2 and found[2] == 0


def test_simulators_repeat(spark):
    contigs = [("a", letters(1, "ACGT", 500))]
    one, two = (simulate.simulate(spark, contigs, 40, 20, 0.05, 0.2, 0.2, seed=4).collect() for _ in range(2))
    assert one == two and {r.kind[:3] for r in one} == {"exa", "ins", "del"}
    p = simulate.simulate_pairs(spark, contigs, 30).collect()
    assert all(r.f_pos - r.r_pos + 25 == r.distance for r in p)
    assert simulate.simulate_expression(spark, [("t1", contigs[0][1], 1.0), ("t2", contigs[0][1][:100], 0.0)], 20).select("transcript_id").distinct().count() == 1


def test_indel_rescue_equals_brute_force(spark):
    draw = random.Random(4)
    seq = letters(11, "0123", 400)
    chunks = spark.createDataFrame([("A", i, seq[i : i + 64]) for i in range(0, 400, 32)], "contig string, chunk_start bigint, colors string")
    beads, reads = [], []
    for bead in range(60):
        pos, n = draw.randrange(0, 300), draw.choice([14, 15, 20])
        at = pos + draw.randrange(5, 60)
        part, cut, d = seq[at : at + n + 4], draw.randrange(2, n - 4), draw.choice([1, 2, 3])
        xor = lambda t: str(np.bitwise_xor.reduce([int(c) for c in t]))
        if bead % 3 == 0 and len(part) > cut + d:
            mate = part[:cut] + xor(part[cut : cut + d + 1]) + part[cut + d + 1 :]
        elif bead % 3 == 1:
            new = letters(bead, "0123", d)
            mate = part[:cut] + new + str(int(xor(new)) ^ int(part[cut : cut + 1] or 0)) + part[cut + 1 :]
        else:
            mate = part
        beads.append((bead, "A", pos))
        reads.append((bead, mate[:n].replace("3", "." if bead % 10 == 9 else "3", 1)))
    anchors, mates = spark.createDataFrame(beads, "bead_id bigint, contig string, pos bigint"), spark.createDataFrame(reads, "bead_id bigint, colors string")
    want, flat = set(), set()
    for (bead, _, pos), (_, mate) in zip(beads, reads, strict=True):
        places = [p for p in range(pos + 4, min(pos + 70, 400 - len(mate)) + 1)]
        found = [(p, x[1], x[0], x[2]) for p in places if (x := extension.one_indel(mate, seq[p:], 3)) and x[2] <= 1]
        want |= {(bead, *f) for f in found if f[3] == min(g[3] for g in found)}
        mm = {p: sum(a != b or a == "." for a, b in zip(mate, seq[p:], strict=False)) for p in places}
        flat |= {(bead, p, v) for p, v in mm.items() if v <= 2 and v == min(mm.values())}
    got = pairs.rescue_indel(anchors, mates, chunks, 32, 4, 70, 3, 1)
    assert {tuple(r) for r in got.select("bead_id", "pos", "size", "cut", "mm").collect()} == want and len({w[0] for w in want}) > 30
    assert pairs.rescue_indel(anchors, mates, chunks, 32, 4, 70, 3, 1, limit=1).count() == len({w[0] for w in want})
    assert {tuple(r) for r in pairs.rescue(anchors, mates, chunks, 32, 4, 70, 2).select("bead_id", "pos", "mm").collect()} == flat
    assert pairs.rescue_indel(anchors.limit(0), mates, chunks, 32, 4, 70, 3, 1).count() == 0


def test_banded_rows_equal_kernel(spark):
    rows = [(i, letters(i, "0123", 8 + i % 4), letters(i + 900, "0123", 9 + i % 5)) for i in range(40)] + [(90, "", "012"), (91, "012", ""), (92, None, None), (93, "0.12", "0312")]
    got = extension.align_banded(spark.createDataFrame(rows, "id int, read_colors string, ref_colors string"), 3).collect()
    assert {r.id: (r.gap_score, r.ref_end, r.n_gaps) for r in got} == {i: extension.banded(a or "", b or "", 3) for i, a, b in rows}


def test_consensus_of_columns_equals_paths(spark):
    draw = random.Random(6)
    rows, want = [], {}
    for name, n, chunk in (("a", 300, 64), ("b", 64, 64), ("c", 65, 64), ("d", 1, 64), ("e", 700, 64), ("f", 2, 64)):
        placed = []
        for _ in range(max(1, n // 20)):
            at = draw.randrange(-5, n) if name != "e" else draw.randrange(0, 90) + 500 * draw.randrange(2)
            placed += [(at, "".join(draw.choice("0123.") for _ in range(draw.randrange(1, 25))))] * draw.choice([1, 2, 4])
        first = draw.choice("ACGT")
        rows += [(name, n, at, c, first) for at, c in placed]
        votes = {}
        for at, colors in placed:
            for i, c in enumerate(colors):
                if c != "." and 0 <= at + i < n - 1:
                    votes.setdefault(at + i, []).append(c)
        colors = {p: min(v, key=lambda c: (-v.count(c), c)) for p, v in votes.items()}
        code, codes = "ACGT".index(first), []
        for p in range(n):
            codes.append(code if p in colors or p - 1 in colors else None)
            code ^= int(colors.get(p, 0))
        want[name] = "".join("N" if c is None else "ACGT"[c] for c in codes)
        # a cheapest path takes the same colours; behind a gap it may go on from any base
        path = assembly.consensus(n, list(colors.items()), first)
        assert [c == "N" for c in path] == [c == "N" for c in want[name]]
        assert all("ACGT".index(t[p]) ^ "ACGT".index(t[p + 1]) == int(c) for t in (path, want[name]) for p, c in colors.items())
    got = {}
    df = spark.createDataFrame(rows, "contig string, length int, pos bigint, colors string, first string")
    for r in assembly.consensus_contigs(df, 64).orderBy("chunk_start").collect():
        got[r.contig] = got.get(r.contig, "") + r.seq
    assert got == want


def test_edit_windows_follow_the_edited_sequence(spark):
    edits = [("a", 10, "I", "GGG"), ("a", 20, "D", "AC"), ("a", 30, "R", "T"), ("b", 7, "R", "T")]
    got = assembly.edit_windows(spark.createDataFrame(edits, "contig string, place bigint, kind string, text string")).collect()
    assert {(r.contig, r.place, r.start0, r.end0) for r in got} == {("a", 10, 5, 15), ("a", 20, 18, 28), ("a", 30, 26, 36), ("b", 7, 2, 12)}


def test_composed_seed_sets():
    known = {(6, 0): ["111111"], (5, 0): ["11111"], (12, 1): seeds.block_masks(12, 1, 4), (6, 1): seeds.block_masks(6, 1, 3)}
    assert seeds.composed(known, 12, 1) == sorted(known[12, 1])  # four masks of nine cost less than two of six
    assert seeds.composed({(6, 0): ["111111"]}, 12, 1) == sorted(["111111000000", "000000111111"])
    two = seeds.composed(known, 12, 2)
    assert seeds.complete(two, 12, 2) and len(two) == 4
    apart = seeds.composed({(6, 0): ["111111"], (5, 0): ["11111"]}, 12, 1, adjacent=True)
    assert seeds.complete(apart, 12, 1, adjacent=True) and len(apart) == 2
    with pytest.raises(ValueError):
        seeds.composed(known, 11, 5)
    best = seeds.best_sets(seeds.block_masks(8, 1, 4) + ["11110000", "00001111"], 8, 1, 3, 4)
    assert len(best) == 3 and all(seeds.complete(b, 8, 1) for b in best) and seeds.chance(best[0]) <= seeds.chance(best[1]) <= seeds.chance(best[2])


def test_consensus_deals_reads_not_letters(spark):
    """Reads go to the chunks that they touch as they are; gaps, dots and chunk borders as in the plain form."""
    draw = random.Random(12)
    reads = [(p, "".join(draw.choice("0123.") for _ in range(90))) for p in [*range(0, 400, 30), 640, 700]]
    df = spark.createDataFrame([("c", 800, p, c) for p, c in reads] + [("d", 1, 0, "")], "contig string, length int, pos bigint, colors string")
    assert assembly._blocks(df, 64).count() <= 3 * len(reads)
    got = {(r.contig, r.chunk_start): r.seq for r in assembly.consensus_contigs(df, 64).collect()}
    text = "".join(got["c", at] for at in range(0, 800, 64))
    votes = [[sum(p <= i < p + 90 and c[i - p] == x for p, c in reads) for x in "0123"] for i in range(799)]
    code, plain = 0, []
    for i in range(800):
        plain.append("ACGT"[code] if (i < 799 and any(votes[i])) or (i and any(votes[i - 1])) else "N")
        code ^= votes[i].index(max(votes[i])) if i < 799 else 0
    assert text == "".join(plain) and got["d", 0] == "N"
