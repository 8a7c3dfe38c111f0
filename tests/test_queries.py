"""Registered queries against their SQL, in DuckDB, at the smallest scale."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from strandweave.plans import oracles, queries, views

SF = "/root/testdata/sf0.001"
SAMPLE = ("unique_best_hit", "feature_counts", "feature_overlap_fraction", "nearest_left", "coverage_rle", "ptr_sweep", "pair_classes", "putative_junctions", "color_encode", "alignment_report", "known_variant_band", "weighted_coverage")


def plain(v):
    return "NULL" if v is None or v != v else f"{v:.6f}" if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in "part lineitem events documents benchmark orders supplier".split():
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    cur = duck.execute(oracles.ORACLES[name])
    names = [d[0] for d in cur.description]
    columns = sorted(df.columns)
    assert sorted(names) == columns
    want = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in cur.fetchall())
    assert sorted(tuple(plain(r[c]) for c in columns) for r in df.collect()) == want and want


def test_every_oracle_has_a_query(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


def test_plans_use_equi_joins(spark):
    plan = queries.feature_counts(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "PythonUDF" not in plan


def test_color_roundtrip_reads_every_letter(spark, duck, monkeypatch):
    test_query_equals_sql(spark, duck, "color_roundtrip")
    # a colour that is spoilt behind the shown letters shows
    encode = queries.color.encode_colors
    spoilt = lambda c: F.regexp_replace(encode(c), "^(.{99}).", "$1.")
    monkeypatch.setattr(queries.color, "encode_colors", spoilt)
    assert queries.color_roundtrip(spark, SF).where("decoded <> read").count() == views.sequences(spark, SF).where("length(seq) > 100").count() > 0


def test_map_reads_tiles_whole_items(spark, tmp_path):
    draw = random.Random(3)
    text = lambda n: "".join(draw.choice("ACGT") for _ in range(n)).translate(str.maketrans("ACGT", "ABCD"))
    long, short = text(80), text(30)
    spark.createDataFrame([(1, long), (2, short), (3, text(26))], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(7, text(11) + long[45:]), (8, short)], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.read_id, r.contig, r.pos0) for r in queries.map_reads(spark, str(tmp_path)).collect() if r.strand == "+" and r.mm == 0}
    assert got == {("1:52", "7", 11 + 52 - 45 + 1), ("1:53", "7", 11 + 53 - 45 + 1), ("2:0", "8", 1), ("2:3", "8", 4)}
