import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandweave.functions import color, scalar, stats
from strandweave.functions.mask import ReadMask

CODE = {b: i for i, b in enumerate("ACGT")}


def one(spark, *columns):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


def test_encode_and_decode_equal_brute_force(spark):
    draw = random.Random(1)
    seqs = ["", "A", "AC", "ACGTN", *["".join(draw.choice("ACGT") for _ in range(draw.randint(2, 40))) for _ in range(30)]]
    df = spark.createDataFrame([(s,) for s in seqs], "s string")
    for r in df.select("s", color.encode_colors(F.col("s")).alias("c"), color.decode_colors(F.substring("s", 1, 1), color.encode_colors(F.col("s"))).alias("d")).collect():
        want = "".join("." if a not in CODE or b not in CODE else str(CODE[a] ^ CODE[b]) for a, b in zip(r.s[:-1], r.s[1:], strict=True))
        assert r.c == want
        if r.s and "N" not in r.s:
            assert r.d == r.s


def test_sequence_functions(spark):
    r = one(spark, color.reverse_complement(F.lit("ACGTRN")), color.iupac_bases(F.lit("r")), color.iupac_colors(F.lit("A"), F.lit("R")), color.color_matches(F.lit("A"), F.lit("R"), F.lit("2")), color.xor_sum(F.lit("0123")), color.xor_sum(F.lit("01.")), color.mismatches(F.lit("01.2"), F.lit("01.3")), color.strand_substring(F.lit("AACCGG"), F.lit(1), F.lit(3), F.lit("-")), color.decode_candidates(F.lit("01")))
    assert list(r) == ["NYACGT", ["A", "G"], [0, 2], True, 0, None, 2, "GGT", ["AAC", "CCA", "GGT", "TTG"]]


def test_valid_adjacent_equals_middle_base_search(spark):
    rows = [(a, b, c, d) for a in range(4) for b in range(4) for c in range(4) for d in range(4)]
    df = spark.createDataFrame(rows, "a int, b int, c int, d int")
    for r in df.select("*", color.valid_adjacent(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("ok")).collect():
        left = 0  # outer bases: any first base, the reference's last
        last = left ^ r.c ^ r.d
        assert r.ok == any((left ^ m) == r.a and (m ^ last) == r.b for m in range(4))


@pytest.mark.parametrize(("text", "masked"), [("", []), ("33", [33]), ("33..", range(33, 41)), ("33..40", range(33, 41)), ("1-5", range(1, 6)), ("1-5,9,33..", [*range(1, 6), 9, *range(33, 41)]), ("5-1,9,33..", [*range(1, 6), 9, *range(33, 41)]), ("41", [])])
def test_read_mask(text, masked):
    assert ReadMask(text).bits(40) == "".join("0" if i in masked else "1" for i in range(1, 41))


def test_mask_parts():
    mask = ReadMask("0101")
    assert mask.bits(4) == "0101" and mask.used(4) == 2
    assert ReadMask("3,10..").part(3, 10).bits(10) == "0111111000"
    with pytest.raises(ValueError):
        ReadMask("x")


def test_sizes_regions_flags():
    assert [scalar.byte_size(x) for x in ("7", "7b", "2KB", "1.5MB", "1gB")] == [7, 7, 2048, 1572864, 1 << 30]
    with pytest.raises(ValueError):
        scalar.byte_size("3 parsecs")
    assert scalar.parse_regions("chr1:50-10, chr2:7,chr3") == [("chr1", 10, 50), ("chr2", 7, None), ("chr3", None, None)]
    assert scalar.split_quoted('a,"b,c",d\\,e') == ["a", "b,c", "d,e"]
    assert scalar.parse_flag("Yes") and not scalar.parse_flag("off") and scalar.safe_name("a b/c") == "a_b_c"
    assert scalar.most_bases(6.5e9) == pytest.approx((6.5e9 - 1.3e9) / 7) and scalar.mapper_memory(10) == 1.3e9 + 70


def test_interval_and_text_functions(spark):
    lit = F.lit
    r = one(spark, scalar.overlap_length(lit(1), lit(10), lit(8), lit(20)), scalar.distance(lit(1), lit(10), lit(15), lit(20)), scalar.contains(lit(1), lit(10), lit(2), lit(10)), scalar.overlap_fractions(lit(1), lit(10), lit(6), lit(25))[1], scalar.attribute(lit('gene_id "G 1"; transcript_id "T";'), "transcript_id"), scalar.amino_acid(lit("ATG")), scalar.amino_acid(lit("ANG")), scalar.translate_orf(lit("ATGTAACC")), scalar.local_score(lit(25), lit(2)))
    assert list(r) == [3, 5, True, 0.25, "T", "M", "X", "M*", 21]
    assert one(spark, scalar.read_parts(F.lit("7_40_12_F3_FILT"))).c0.asDict() == {"panel": 7, "x": 40, "y": 12, "tag": "F3"}


def test_junction_lift_over_round_trip(spark):
    for strand in "+-":
        genome = [10, 11, 12, 13, 20, 21, 22]
        order = genome if strand == "+" else genome[::-1]
        rows = spark.range(7).select(scalar.junction_to_genome(F.col("id"), F.lit(10), F.lit(13), F.lit(20), F.lit(22), F.lit(strand)).alias("g")).collect()
        assert [r.g for r in rows] == order
    a, b = scalar.junction_sides(F.lit(1), F.lit(5), F.lit(4), F.lit(3), F.lit("+"))
    assert list(one(spark, a, b, scalar.spans_junction(F.lit(1), F.lit(5), F.lit(4), F.lit(3), F.lit("+"), 2))) == [3, 2, True]


def test_natural_order(spark):
    df = spark.createDataFrame([("chr10",), ("chr2",), ("chrX",)], "s string")
    assert [r.s for r in df.orderBy(*scalar.natural_key(F.col("s"))).collect()] == ["chr2", "chr10", "chrX"]


def test_statistics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.5), (4.0, 7.0), (float("nan"), 1.0)], "x double, y double")
    r = df.agg(stats.mean(F.col("x")), stats.variance(F.col("x")), stats.variance(F.col("x"), True), stats.median(F.col("x"))).first()
    assert r[0] == pytest.approx(7 / 3) and r[1] == pytest.approx(np.var([1, 2, 4], ddof=1)) and r[2] == pytest.approx(r[1] * 2 / 3) and r[3] == 2
    assert stats.hypergeometric_tail(0, 5, 5, 20) == pytest.approx(1) and stats.hypergeometric_tail(5, 5, 5, 20) == pytest.approx(1 / math.comb(20, 5))
    assert stats.log10_poisson_tail(3, 2.0) == pytest.approx(math.log10(1 - math.exp(-2) * (1 + 2 + 2)))
    assert stats.permutation_p(np.arange(8), np.arange(8), 500) < 0.02
    assert sum(stats.redistribute(5, 7, 0.5)) == 12
