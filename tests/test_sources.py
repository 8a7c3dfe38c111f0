import gzip

from pyspark.sql import functions as F

from strandweave.sources import readers, writers


def write(tmp_path, name, text, zipped=False):
    path = tmp_path / name
    (gzip.open(path, "wt") if zipped else path.open("w")).write(text)
    return str(path)


def test_fasta(spark, tmp_path):
    path = write(tmp_path, "a.fa", "# made here\n>c1 first\nacgt\nAC\n>c2\nGG\n")
    rows = {r.contig_id: (r.header, r.seq) for r in readers.fasta(spark, path).collect()}
    assert rows == {"c1": ("c1 first", "ACGTAC"), "c2": ("c2", "GG")}
    seqs = readers.fasta(spark, path)
    assert readers.totals(readers.contigs(spark, path)).first().asDict() == {"n_contigs": 2, "bases": 8}
    assert readers.fetch(seqs, "C1 FIRST").count() == 1 and readers.fetch(seqs, "c", prefix=True).count() == 2
    assert readers.subset(seqs, seqs.where("contig_id = 'c2'")).first().seq == "GG"
    lines = "\n".join(r.value for r in writers.fasta_lines(seqs, 4).orderBy("value").collect())
    assert lines == ">c1 first\nACGT\nAC\n>c2\nGG"


def test_reads_plain_and_gzip(spark, tmp_path):
    text = "# Title: x\n>7_40_12_F3\nT2031.2\n>7_41_3_F3\nT001122\n"
    for zipped in (False, True):
        path = write(tmp_path, "r.csfasta" + ".gz" * zipped, text, zipped)
        rows = readers.csfasta(spark, path).orderBy("x").collect()
        assert [(r.read_id, r.panel, r.x, r.y, r.tag, r.primer, r.colors) for r in rows] == [("7_40_12_F3", 7, 40, 12, "F3", "T", "2031.2"), ("7_41_3_F3", 7, 41, 3, "F3", "T", "001122")]
    assert [r.read_id for r in readers.csfasta(spark, path, 2, 2).collect()] == ["7_41_3_F3"]


def test_hit_and_alignment_lists(spark, tmp_path):
    hits = readers.hit_lists(spark, write(tmp_path, "h.ma", ">7_40_12_F3,1_123.0,2_-456.2\nT20\n>7_41_3_F3\nT20\n"))
    assert sorted((r.contig_idx, r.pos0, r.strand, r.mm) for r in hits.collect()) == [(1, 123, "+", 0), (2, 456, "-", 2)]
    path = write(tmp_path, "a.max", ">7_40_12_F3,1.1041.1.45.43.1###,2.-0.3.20.18.1#7.9#3:1#\n")
    rows = readers.alignment_lists(spark, path)
    got = {r.contig_idx: (r.pos0, r.strand, r.aln_len, r.score, list(r.va), [tuple(x) for x in r.ins_read]) for r in rows.collect()}
    assert got == {1: (1041, "+", 45, 43, [], []), 2: (0, "-", 20, 18, [7, 9], [(3, 1)])}  # a minus hit at 0 keeps its strand
    again = writers.alignment_lines(rows, with_pairs=True).first().value
    assert again == ">7_40_12_F3,1.1041.1.45.43.1###,2.-0.3.20.18.1#7.9#3:1#"


def test_features(spark, tmp_path):
    path = write(tmp_path, "g.gtf", '#x\nc\ts\texon\t10\t20\t.\t+\t.\tgene_id "g"; transcript_id "t1";\nc\ts\texon\t10\t20\t.\t+\t.\tgene_id "g"; transcript_id "t2";\nc\ts\tCDS\t12\t18\t1.0\t-\t0\t.\n')
    rows = readers.features(spark, path)
    exon = readers.unique_exons(rows).first()
    assert (exon.start1, exon.gene_ids, exon.transcript_ids) == (10, ["g"], ["t1", "t2"])
    assert readers.exons(rows).count() == 2 and readers.features(spark, path, 3).agg(F.min("start1")).first()[0] == 7
    assert rows.where("ftype = 'CDS'").first().attributes is None
    assert writers.feature_lines(rows.where("ftype = 'CDS'")).first().value == "c\ts\tCDS\t12\t18\t1.0\t-\t0\t."


def test_transcripts(spark, tmp_path):
    good = "1\tNM_1\tchr1\t+\t99\t300\t109\t250\t2\t99,199,\t150,300,\t0\tG\tcmpl\tcmpl\t0,1,"
    path = write(tmp_path, "t.txt", f"#bin\n{good}\n1\tbroken\n")
    rows = readers.transcripts(spark, path)
    assert [(r.exon_no, r.start1, r.end1, r.frame) for r in readers.transcript_exons(rows).orderBy("exon_no").collect()] == [(0, 100, 150, 0), (1, 200, 300, 1)]
    assert readers.malformed(spark, path).count() == 1
    got = sorted((r.ftype, r.start1, r.end1, r.phase) for r in writers.gtf_rows(rows).collect())
    assert got == sorted([("CDS", 110, 150, "0"), ("CDS", 200, 250, "2"), ("exon", 100, 150, None), ("exon", 200, 300, None), ("start_codon", 110, 112, None)])


def test_small_tables(spark, tmp_path):
    v = readers.variants(spark, write(tmp_path, "v.txt", "1\tchr1\t-\tA/G\n2\tchr1\t+\tA/G\n"), {"id": 0, "contig": 1, "strand": 2, "alleles": 3})
    assert sorted((r.id, r.alleles) for r in v.collect()) == [("1", "T/C"), ("2", "A/G")]
    m = readers.score_matrix(spark, write(tmp_path, "m.txt", " ".join(map(str, range(16))) + "\n"))
    assert m.where("ref_color = 2 and read_color = 1").first().cost == 9
    assert [r["mask"] for r in readers.seed_masks(spark, write(tmp_path, "s.txt", "$ x\n1101\n111\n")).collect()] == ["1101", "111"]
    assert readers.provenance(spark, write(tmp_path, "p.txt", "#a=1\nx\n#b=\n")) == {"a": "1", "b": ""}
    assert [tuple(r) for r in readers.column_file(spark, write(tmp_path, "c.txt", "a\tb\tc\n"), [2, 0]).collect()] == [("c", "a")]


def test_wig(spark, tmp_path):
    runs = spark.createDataFrame([("c", "+", 4, 6, 2), ("c", "-", 0, 1, 1)], "contig string, strand string, start0 bigint, end0_excl bigint, depth bigint")
    out = str(tmp_path / "wig")
    writers.write_wig(runs, out)
    assert [r.value for r in spark.read.text(f"{out}/track=plus_c").collect()] == ["variableStep chrom=c", "5 2", "6 2"]
    numbered = writers.region_features(spark.createDataFrame([("c", "+", 4, 6), ("c", "+", 9, 12)], "contig string, strand string, start0 bigint, end0 bigint"))
    assert sorted((r.start1, r.attributes) for r in numbered.collect()) == [(5, "ID=c_+_1"), (10, "ID=c_+_2")]
