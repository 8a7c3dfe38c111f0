from strandweave.operators import merging, simulate


def test_merging(spark):
    reads = spark.createDataFrame([(1, "A"), (2, "C")], "read_id int, seq string")
    hits = spark.createDataFrame([(1, 0, "c2", 5, "+")], "read_id int, mm int, contig string, pos0 bigint, strand string")
    more = spark.createDataFrame([(1, 0, "c1", 9, "-")], hits.schema)
    row = merging.merge_hits([hits, more], reads, "hit").first()
    assert [(h.contig, h.pos0) for h in row.hits] == [("c1", 9), ("c2", 5)]
    assert [r.read_id for r in merging.merge_hits([hits, more], reads, "missed").collect()] == [2]
    assert merging.merge_hits([hits], reads).count() == 2 == merging.attach_reads(hits, reads, True).count()
    r, f = spark.createDataFrame([(1, 5), (2, 6)], "bead_id int, r int"), spark.createDataFrame([(2, 7), (3, 8)], "bead_id int, f int")
    assert {x.bead_id: x.side for x in merging.merge_tags(r, f).collect()} == {1: "r_only", 2: "both", 3: "f_only"}
    assert [x.bead_id for x in merging.by_barcode(r, f).collect()] == [2]
    assert sorted((x.bead_id, x.r) for x in merging.reuse(r, spark.createDataFrame([(2, 0)], r.schema)).collect()) == [(1, 5), (2, 0)]


def test_positions(spark):
    contigs = spark.createDataFrame([(1, 10), (2, 5)], "contig_idx int, length bigint")
    got = {r.offset: (r.contig_idx, r.pos0) for r in merging.locate(spark.createDataFrame([(0,), (9,), (10,), (14,), (15,)], "offset bigint"), contigs).collect()}
    assert got == {0: (1, 0), 9: (1, 9), 10: (2, 0), 14: (2, 4)}
    hits = spark.createDataFrame([(1, "A", "+", 100), (2, "A", "-", 400), (3, "B", "+", 100)], "id int, contig string, strand string, pos bigint")
    low = spark.createDataFrame([("A", 210, 220)], "contig string, start0 bigint, end0 bigint")
    assert sorted(r.id for r in merging.near_regions(hits, low, 100, 200).collect()) == [1, 2]


def test_colors_and_panels(spark):
    got = {r.pair: r.n for r in merging.dicolor_counts(spark.createDataFrame([("0101",), ("01",)], "colors string")).collect()}
    assert got["01"] == 3 and got["10"] == 2 and len(got) == 16
    panels = spark.range(10).selectExpr("id panel")
    assert [r.panel for r in merging.some_panels(panels, 3).collect()] == [0, 1, 2] and merging.some_panels(panels, 3, 1).count() == 3
    assert merging.panel_groups(panels, 5).groupBy("panel_group").count().where("count = 2").count() == 5


def test_base_space_mapping(spark):
    seq = "ACGTTGCAAGGCTTACCGATCGGATTACAGGCTA"
    reads = spark.createDataFrame([("f", seq[4:20]), ("r", simulate.reverse_complement(seq[10:26])), ("m", seq[4:11] + "A" + seq[12:20])], "read_id string, seq string")
    got = {(r.read_id, r.pos0, r.strand, r.mm) for r in merging.sequence_matches(reads, spark.createDataFrame([("c", seq)], "contig string, seq string"), 16, 1).collect()}
    assert got == {("f", 4, "+", 0), ("r", 10, "-", 0), ("m", 4, "+", int(seq[11] != "A"))}


def test_offsets_in_many_short_contigs(spark):
    """Contigs of 1 to 40 bases, an empty one and a very long one; every offset against every contig of a wide bin takes billions of pairs."""
    sizes = {i: i * 7 % 40 + 1 for i in range(1, 60_001)} | {70_000: 0, 80_000: 10**9, 90_000: 3}
    contigs = spark.createDataFrame(list(sizes.items()), "contig_idx bigint, length bigint")
    want, at = {}, 0
    for i, n in sizes.items():
        want |= {at + k: (i, k) for k in ({0, n - 1} if n else ())}
        at += n
    offsets = spark.createDataFrame([(p,) for p in [*want, at, -1]], "offset bigint")
    assert {r.offset: (r.contig_idx, r.pos0) for r in merging.locate(offsets, contigs).collect()} == want
    assert merging.locate(offsets, contigs.where("false")).count() == 0
