"""Further queries over the driver's tables, each beside its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import color, scalar, stats
from ..functions.mask import ReadMask
from ..functions.color import IUPAC
from ..lineage import cut, shared_folder
from ..operators import alignments as al
from ..operators import assembly, chain, extension, junctions, mapping, merging, ntr, pairs, variants
from ..sources import readers, store, writers
from . import views
from .oracles import ALN, FEAT, LETTERS, SEQ, SEQS
from .oracles import ORACLES as BASE_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def sql(text: str | None):
    """Registers a query, and its SQL where it has one."""

    def put(f):
        QUERIES[f.__name__] = f
        if text is not None:
            ORACLES[f.__name__] = text
        return f

    return put


L = "bigint"

# -- scalar functions ----------------------------------------------------------


@sql(f"""WITH {SEQS} SELECT doc_id, sha256(CASE WHEN doc_id % 2 = 1 THEN reverse(translate(part, 'ACGT', 'TGCA')) ELSE part END) AS part_sha256
FROM (SELECT doc_id, substr(seq, doc_id % 7 + 1, length(seq)) AS part FROM seqs)""")
def strand_slices(spark, sf_dir):
    s = views.sequences(spark, sf_dir)
    part = color.strand_substring(F.col("seq"), (F.col("doc_id") % 7).cast("int"), F.length("seq"), F.when(F.col("doc_id") % 2 == 1, "-").otherwise("+"))
    return s.select("doc_id", F.sha2(part, 256).alias("part_sha256"))


_CODES = "".join(IUPAC)
_IUP = "iup AS (SELECT code, unnest(string_split(bases, '')) AS base FROM (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in IUPAC.items()) + ") t(code, bases)), num AS (SELECT code, instr('ACGT', base) - 1 AS n FROM iup)"


def _triples(spark, sf_dir):
    k = F.col("p_partkey")
    letter = lambda d: F.substring(F.lit(_CODES), (F.floor(k / d) % 15 + 1).cast("int"), F.lit(1))
    return views.table(spark, sf_dir, "part").select(k, letter(1).alias("a"), letter(15).alias("b"), letter(225).alias("c"))


_TRIPLES = f"tri AS (SELECT p_partkey, substr('{_CODES}', p_partkey % 15 + 1, 1) AS a, substr('{_CODES}', p_partkey // 15 % 15 + 1, 1) AS b, substr('{_CODES}', p_partkey // 225 % 15 + 1, 1) AS c FROM part)"


@sql(f"""WITH {_IUP}, {_TRIPLES} SELECT p_partkey, string_agg(DISTINCT CAST(xor(x.n, y.n) AS VARCHAR) || CAST(xor(y.n, z.n) AS VARCHAR), ',' ORDER BY CAST(xor(x.n, y.n) AS VARCHAR) || CAST(xor(y.n, z.n) AS VARCHAR)) AS pairs
FROM tri JOIN num x ON x.code = a JOIN num y ON y.code = b JOIN num z ON z.code = c GROUP BY p_partkey""")
def iupac_triples(spark, sf_dir):
    return _triples(spark, sf_dir).select("p_partkey", F.array_join(color.iupac_triple_colors(F.col("a"), F.col("b"), F.col("c")), ",").alias("pairs"))


@sql(f"""WITH {_IUP}, {_TRIPLES}, sets AS (SELECT p_partkey, string_agg(DISTINCT xor(x.n, y.n), ',' ORDER BY xor(x.n, y.n)) AS colors, count(DISTINCT x.n) AS n_bases, max(CASE WHEN xor(x.n, y.n) = p_partkey % 4 THEN 1 ELSE 0 END) = 1 AS fits
  FROM tri JOIN num x ON x.code = a JOIN num y ON y.code = b GROUP BY p_partkey) SELECT p_partkey, colors, n_bases, fits FROM sets""")
def iupac_pairs(spark, sf_dir):
    a, b = F.col("a"), F.col("b")
    return _triples(spark, sf_dir).select("p_partkey", F.array_join(color.iupac_colors(a, b).cast("array<string>"), ",").alias("colors"), F.size(color.iupac_bases(a)).cast(L).alias("n_bases"), color.color_matches(a, b, F.col("p_partkey") % 4).alias("fits"))


@sql("SELECT l_orderkey, l_linenumber, xor(l_partkey % 4, l_suppkey % 4) = xor(l_orderkey % 4, CAST(l_quantity AS BIGINT) % 4) AS fits FROM lineitem")
def valid_adjacent_pairs(spark, sf_dir):
    c = [F.col(x).cast(L) % 4 for x in ("l_partkey", "l_suppkey", "l_orderkey", "l_quantity")]
    return views.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", color.valid_adjacent(*c).alias("fits"))


@sql(f"""WITH {SEQS} SELECT doc_id, sha256(repeat('.', least(5, length(seq))) || substr(seq, 6, 3) || CASE WHEN length(seq) >= 9 THEN '.' ELSE '' END || substr(seq, 10, 23) || repeat('.', greatest(0, length(seq) - 32))) AS masked_sha256 FROM seqs""")
def read_masks(spark, sf_dir):
    return views.sequences(spark, sf_dir).select("doc_id", F.sha2(ReadMask("5-1,9,33..").apply(F.col("seq")), 256).alias("masked_sha256"))


@sql("""SELECT p_partkey, p_brand AS name, CASE WHEN p_partkey % 3 = 0 THEN NULL WHEN p_partkey % 3 = 1 THEN p_partkey ELSE least(p_partkey, 50 * p_size) END AS low, CASE WHEN p_partkey % 3 = 2 THEN greatest(p_partkey, 50 * p_size) END AS high FROM part""")
def regions_parsed(spark, sf_dir):
    k, m = F.col("p_partkey").cast("string"), F.col("p_partkey") % 3
    text = F.when(m == 0, F.col("p_brand")).when(m == 1, F.concat_ws(":", "p_brand", k)).otherwise(F.concat(F.col("p_brand"), F.lit(":"), k, F.lit("-"), (50 * F.col("p_size")).cast("string")))
    return views.table(spark, sf_dir, "part").select("p_partkey", scalar.region(text).alias("r")).select("p_partkey", "r.*")


@sql("""WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey AS s1, l_partkey + CAST(l_quantity AS BIGINT) AS e1, 7 * l_suppkey AS s2, 7 * l_suppkey + l_linenumber AS e2 FROM lineitem)
SELECT l_orderkey, l_linenumber, e1 - s1 + 1 AS len, least(e1, e2) - greatest(s1, s2) + 1 AS shared, greatest(s2 - e1, s1 - e2, 0) AS dist, s1 <= s2 AND e2 <= e1 AS holds, s1 <= e2 AND s2 <= e1 AS meets FROM t""")
def interval_relations(spark, sf_dir):
    a = (F.col("l_partkey"), F.col("l_partkey") + F.col("l_quantity").cast(L))
    b = (7 * F.col("l_suppkey"), 7 * F.col("l_suppkey") + F.col("l_linenumber"))
    return views.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", scalar.interval_length(*a).alias("len"), scalar.overlap_length(*a, *b).alias("shared"), scalar.distance(*a, *b).alias("dist"), scalar.contains(*a, *b).alias("holds"), scalar.overlaps(*a, *b).alias("meets"))


@sql(f"""WITH {ALN} SELECT read_id, hit_no, CASE WHEN strand = '-' THEN end0 ELSE start0 END AS first_at, CASE WHEN strand = '-' THEN start0 ELSE end0 END AS last_at, CASE WHEN strand = '-' THEN end0 + hit_no ELSE start0 - hit_no END AS key FROM aln""")
def color_positions(spark, sf_dir):
    a = (F.col("start0"), F.col("aln_len"), F.col("strand"))
    return views.alignments(spark, sf_dir).select("read_id", "hit_no", scalar.first_color_position(*a).alias("first_at"), scalar.last_color_position(*a).alias("last_at"), scalar.collapse_key(a[0], a[1], F.col("hit_no"), a[2]).alias("key"))


@sql(f"""WITH {FEAT}, t AS (SELECT feature_id, feature_id % 41 AS p, CASE WHEN f_strand = '-' THEN 40 - feature_id % 41 ELSE feature_id % 41 END AS k, start1 AS ls, end1 + 30 AS rs FROM feat)
SELECT feature_id, CASE WHEN k < 21 THEN ls + k ELSE rs + k - 21 END AS genome, p AS back FROM t""")
def junction_positions(spark, sf_dir):
    f = views.features(spark, sf_dir)
    place = (F.col("start1"), F.col("start1") + 20, F.col("end1") + 30, F.col("end1") + 49, F.col("f_strand"))
    at = f.withColumn("genome", scalar.junction_to_genome(F.col("feature_id") % 41, *place))
    return at.select("feature_id", "genome", scalar.genome_to_junction(F.col("genome"), *place).alias("back"))


@sql(f"WITH {FEAT} SELECT feature_id, gene AS gene_id, transcript AS transcript_id, CAST(NULL AS VARCHAR) AS missing FROM feat")
def gtf_attributes(spark, sf_dir):
    text = F.concat(F.lit('gene_id "'), F.col("gene"), F.lit('"; transcript_id "'), F.col("transcript"), F.lit('"; ID=x'))
    f = views.features(spark, sf_dir).withColumn("attributes", text)
    return f.select("feature_id", *[scalar.attribute(F.col("attributes"), k).alias(n) for k, n in (("gene_id", "gene_id"), ("transcript_id", "transcript_id"), ("none_id", "missing"))])


_AMINO = f"""coalesce(nullif(substr('{scalar.AMINO}', CAST((instr('TCAG', c[1]) - 1) * 16 + (instr('TCAG', c[2]) - 1) * 4 + instr('TCAG', c[3]) AS BIGINT), 1), ''), 'X')"""


@sql(f"""WITH {SEQS}, codons AS (SELECT doc_id, regexp_extract_all(seq, '...') AS cs FROM seqs)
SELECT doc_id, sha256(array_to_string(list_transform(cs, lambda c: {_AMINO}), '')) AS amino_sha256 FROM codons""")
def orf_translation(spark, sf_dir):
    return views.sequences(spark, sf_dir).select("doc_id", F.sha2(scalar.translate_orf(F.col("seq")), 256).alias("amino_sha256"))


@sql(f"WITH {ALN} SELECT read_id, hit_no, aln_len * 2 + mm * -5 AS local_score, CAST(round(10 * (1 - pow(10.0::DOUBLE, -greatest(score, 0) / 10.0::DOUBLE))) AS INTEGER) AS cost FROM aln")
def local_scores(spark, sf_dir):
    a = views.alignments(spark, sf_dir)
    return a.select("read_id", "hit_no", scalar.local_score(F.col("aln_len"), F.col("mm"), 2, -3).alias("local_score"), scalar.quality_weight(F.col("score")).alias("cost"))


@sql("SELECT l_orderkey, l_linenumber, CAST(l_suppkey AS INTEGER) AS panel, CAST(l_partkey AS INTEGER) AS x, CAST(l_linenumber AS INTEGER) AS y, CASE WHEN l_returnflag <> 'A' THEN 'F3' END AS tag FROM lineitem")
def read_names(spark, sf_dir):
    name = F.concat_ws("_", F.col("l_suppkey").cast("string"), F.col("l_partkey").cast("string"), F.col("l_linenumber").cast("string"), F.when(F.col("l_returnflag") != "A", "F3"), F.when(F.col("l_returnflag") == "N", "FILT"))
    return views.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", scalar.read_parts(name).alias("p")).select("l_orderkey", "l_linenumber", "p.*")


# -- reads and hits ------------------------------------------------------------


def _reads(spark, sf_dir):
    return views.sequences(spark, sf_dir, "benchmark", "item_id").select(F.col("item_id").cast("string").alias("read_id"), F.lit("T").alias("primer"), F.translate("seq", "ACGT", "0123").alias("colors"))


_READS = f"reads AS (SELECT CAST(item_id AS VARCHAR) AS read_id, translate({SEQ}, 'ACGT', '0123') AS colors FROM benchmark)"


@sql(f"WITH {_READS} SELECT read_id, 0 AS split_no, 'T' AS primer, substr(colors, 1, 25) AS colors FROM reads UNION ALL SELECT read_id, 1, 'T', '0' || right(colors, 30) FROM reads")
def split_read_parts(spark, sf_dir):
    return mapping.split_reads(_reads(spark, sf_dir), 25, 30).select("read_id", "split_no", "primer", "colors")


@sql(f"WITH {_READS} SELECT read_id, left(rpad(colors, 500, '.'), 500) AS colors FROM reads")
def resized_reads(spark, sf_dir):
    return _reads(spark, sf_dir).select("read_id", mapping.resize(F.col("colors"), 500).alias("colors"))


@sql(f"WITH {ALN} SELECT read_id, hit_no FROM aln WHERE read_id NOT IN (SELECT read_id FROM aln WHERE mm = 3)")
def clean_hits(spark, sf_dir):
    hits = views.alignments(spark, sf_dir)
    return al.without_contaminants(hits, hits.where("mm = 3")).select("read_id", "hit_no")


_ORDERS = "SELECT o_orderkey AS read_id, o_orderpriority AS tag FROM orders"


def _named(spark, sf_dir):
    return views.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("read_id"), F.col("o_orderpriority").alias("tag"))


@sql(f"WITH {ALN} SELECT read_id, hit_no, tag FROM aln JOIN ({_ORDERS}) USING (read_id)")
def hits_with_reads(spark, sf_dir):
    return merging.attach_reads(views.alignments(spark, sf_dir), _named(spark, sf_dir)).select("read_id", "hit_no", "tag")


@sql(f"WITH {ALN} SELECT o.read_id, hit_no, tag FROM ({_ORDERS}) o LEFT JOIN (SELECT * FROM aln WHERE mm = 0) a USING (read_id)")
def reads_with_hits(spark, sf_dir):
    return merging.attach_reads(views.alignments(spark, sf_dir).where("mm = 0"), _named(spark, sf_dir), keep_all=True).select("read_id", "hit_no", "tag")


_TEXT = "string_agg(concat_ws('/', mm, contig, pos0, strand), ',' ORDER BY mm, contig, pos0, strand)"
_MERGED = f"{ALN}, per AS (SELECT read_id, {_TEXT} AS hits FROM (SELECT read_id, mm, contig, start0 AS pos0, strand FROM aln WHERE mm < 2) GROUP BY read_id)"


def _merged(mode):
    def query(spark, sf_dir):
        hits = views.alignments(spark, sf_dir).where("mm < 2").select("read_id", "mm", "contig", F.col("start0").alias("pos0"), "strand", "hit_no")
        parts = [hits.where(F.col("hit_no") % 2 == i).drop("hit_no") for i in (0, 1)]
        found = merging.merge_hits(parts, _named(spark, sf_dir), mode)
        if mode == "missed":
            return found.select("read_id", "tag")
        text = F.array_join(F.transform("hits", lambda h: F.concat_ws("/", h["mm"].cast("string"), h["contig"], h["pos0"].cast("string"), h["strand"])), ",")
        return found.select("read_id", "tag", text.alias("hits"))

    query.__name__ = f"merged_hits_{mode}"
    return query


sql(f"WITH {_MERGED} SELECT read_id, tag, hits FROM ({_ORDERS}) LEFT JOIN per USING (read_id)")(_merged("all"))
sql(f"WITH {_MERGED} SELECT read_id, tag, hits FROM ({_ORDERS}) JOIN per USING (read_id)")(_merged("hit"))
sql(f"WITH {_MERGED} SELECT read_id, tag FROM ({_ORDERS}) WHERE read_id NOT IN (SELECT read_id FROM per)")(_merged("missed"))

_SIDES = f"{ALN}, r AS (SELECT read_id AS bead_id, min(score) AS r_score FROM aln WHERE hit_no % 2 = 1 AND mm < 2 GROUP BY 1), f AS (SELECT read_id AS bead_id, max(score) AS f_score FROM aln WHERE hit_no % 2 = 0 AND mm < 2 GROUP BY 1)"


def _sides(spark, sf_dir):
    hits = views.alignments(spark, sf_dir).where("mm < 2").withColumnRenamed("read_id", "bead_id")
    return hits.where(F.col("hit_no") % 2 == 1).groupBy("bead_id").agg(F.min("score").alias("r_score")), hits.where(F.col("hit_no") % 2 == 0).groupBy("bead_id").agg(F.max("score").alias("f_score"))


@sql(f"WITH {_SIDES} SELECT bead_id, r_score, f_score, CASE WHEN f_score IS NULL THEN 'r_only' WHEN r_score IS NULL THEN 'f_only' ELSE 'both' END AS side FROM r FULL JOIN f USING (bead_id)")
def merged_tags(spark, sf_dir):
    return merging.merge_tags(*_sides(spark, sf_dir))


@sql(f"WITH {_SIDES} SELECT bead_id, r_score, f_score FROM r JOIN f USING (bead_id)")
def barcode_pairs(spark, sf_dir):
    return merging.by_barcode(*_sides(spark, sf_dir))


@sql(f"WITH {_SIDES} SELECT bead_id, r_score AS score FROM r UNION ALL SELECT bead_id, f_score FROM f WHERE bead_id NOT IN (SELECT bead_id FROM r)")
def reused_results(spark, sf_dir):
    r, f = _sides(spark, sf_dir)
    return merging.reuse(f.select("bead_id", F.col("f_score").alias("score")), r.select("bead_id", F.col("r_score").alias("score")))


@sql(f"""WITH {ALN}, {FEAT}, h AS (SELECT read_id, hit_no, contig, CASE WHEN strand = '-' THEN start0 - 90 ELSE start0 + 40 END AS s, CASE WHEN strand = '-' THEN start0 - 40 ELSE start0 + 90 END AS e FROM aln)
SELECT read_id, hit_no FROM h WHERE EXISTS (SELECT 1 FROM feat f WHERE f.contig = h.contig AND f.start1 % 5 = 0 AND h.s <= f.end1 AND f.start1 <= h.e)""")
def reads_near_regions(spark, sf_dir):
    hits = views.alignments(spark, sf_dir).select("read_id", "hit_no", "contig", "strand", F.col("start0").alias("pos"))
    regions = views.features(spark, sf_dir).where("start1 % 5 = 0").select("contig", F.col("start1").alias("start0"), F.col("end1").alias("end0"))
    return merging.near_regions(hits, regions, 40, 90).select("read_id", "hit_no")


@sql("""WITH ends AS (SELECT p_partkey AS contig_idx, sum(p_size) OVER (ORDER BY p_partkey) AS e, p_size AS n FROM part), o AS (SELECT l_orderkey, l_linenumber, l_suppkey * 97 + l_linenumber AS pt FROM lineitem)
SELECT l_orderkey, l_linenumber, contig_idx, CAST(pt - (e - n) AS BIGINT) AS pos0 FROM o JOIN ends ON pt >= e - n AND pt < e""")
def located_offsets(spark, sf_dir):
    contigs = views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("contig_idx"), F.col("p_size").cast(L).alias("length"))
    offsets = views.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_suppkey") * 97 + F.col("l_linenumber")).cast(L).alias("offset"))
    return merging.locate(offsets, contigs).select("l_orderkey", "l_linenumber", "contig_idx", "pos0")


_KEYED = "SELECT *, hit_no % 2 AS split_no, hit_no % 3 AS read_start, CASE WHEN strand = '-' THEN start0 + aln_len - 1 + hit_no % 3 ELSE start0 - hit_no % 3 END AS key FROM aln"


@sql(f"WITH {ALN}, k AS ({_KEYED}), r AS (SELECT *, row_number() OVER (PARTITION BY read_id, contig, strand, key ORDER BY score DESC, split_no, start0) AS rk FROM k) SELECT read_id, contig, strand, split_no, start0, score FROM r WHERE rk = 1")
def collapsed_hits(spark, sf_dir):
    hits = views.alignments(spark, sf_dir).withColumn("split_no", F.col("hit_no") % 2).withColumn("read_start", F.col("hit_no") % 3)
    return al.collapse(hits).select("read_id", "contig", "strand", "split_no", "start0", "score")


@sql("SELECT l_returnflag, round(avg(l_quantity), 6) AS mean, count(*) AS n FROM lineitem GROUP BY l_returnflag")
def merged_means(spark, sf_dir):
    parts = views.table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.avg("l_quantity").alias("mean"), F.count(F.lit(1)).alias("n"))
    return ntr.merge_means(parts, ["l_returnflag"], "mean", "n").withColumn("mean", F.round("mean", 6))


@sql(f"""WITH {SEQS}, c AS (SELECT translate(seq, 'ACGT', '0123') AS colors FROM seqs), grid AS (SELECT a || b AS pair FROM (VALUES ('0'), ('1'), ('2'), ('3')) x(a), (VALUES ('0'), ('1'), ('2'), ('3')) y(b))
SELECT pair, (SELECT count(*) FROM c WHERE contains(colors, pair)) + 1 AS n FROM grid""")
def dicolor_reads(spark, sf_dir):
    reads = views.sequences(spark, sf_dir).select(F.translate("seq", "ACGT", "0123").alias("colors"))
    return merging.dicolor_counts(reads)


@sql(f"""WITH {SEQS}, t AS (SELECT doc_id, string_split(left(seq, length(seq) // 2), '') AS a, string_split(right(seq, length(seq) // 2), '') AS b, length(seq) // 2 AS n FROM seqs WHERE length(seq) > 1)
SELECT doc_id, CAST(list_sum(list_transform(range(1, n + 1), lambda i: CASE WHEN a[i] <> b[i] THEN round(10 * (1 - pow(10.0::DOUBLE, -((i * 7 + doc_id) % 40) / 10.0::DOUBLE))) ELSE 0 END)) AS BIGINT) AS cost FROM t""")
def rescored_reads(spark, sf_dir):
    n = F.floor(F.length("seq") / 2).cast("int")
    rows = views.sequences(spark, sf_dir).where("length(seq) > 1").select("doc_id", F.left("seq", n).alias("read_colors"), F.right("seq", n).alias("ref_colors"), F.transform(F.sequence(F.lit(1), n), lambda i: ((i * 7 + F.col("doc_id")) % 40).cast("int")).alias("quality"))
    return extension.rescore(rows).select("doc_id", "cost")


@sql("""WITH t AS (SELECT *, l_orderkey || '_' || l_linenumber || '_R3' AS bead_id, CAST(l_quantity AS BIGINT) AS q, CASE WHEN l_suppkey % 2 = 0 THEN l_partkey ELSE -l_partkey END AS pos, l_suppkey % 9 AS cut, 11 + l_linenumber % 5 AS a, 13 + l_suppkey % 4 AS b FROM lineitem WHERE l_linenumber <> 7)
SELECT bead_id, CAST(l_linenumber AS INTEGER) AS contig, CASE WHEN pos < 0 THEN -pos - cut ELSE pos + cut END AS pos, CAST(a + b - q + 1 AS INTEGER) AS size, CAST(l_suppkey % 3 AS INTEGER) AS mm, l_orderkey AS r_pos, abs(pos) AS f_pos FROM t""")
def indel_records(spark, sf_dir):
    pos = F.when(F.col("l_suppkey") % 2 == 0, F.col("l_partkey")).otherwise(-F.col("l_partkey"))
    v = lambda c: c.cast("string")
    n, s = F.col("l_linenumber"), F.col("l_suppkey")
    line = F.concat(v(F.col("l_orderkey")), F.lit("_"), v(n), F.lit("_R3,1_"), v(F.col("l_orderkey")), F.lit(".1"), F.when(n == 7, "=").otherwise("|"), v(n), F.lit("_"), v(pos), F.lit("."), v(F.col("l_quantity").cast(L)), F.lit("."), v(s % 3), F.lit("("), v(s % 9), F.lit(","), v(11 + n % 5), F.lit("_"), v(13 + s % 4), F.lit(")"))
    return pairs.parse_indels(views.table(spark, sf_dir, "lineitem").select(line.alias("value")))


def _doc_junctions(spark, sf_dir, seqs=None):
    s = (seqs or views.sequences(spark, sf_dir)).where("length(seq) >= 100")
    n = F.length("seq").cast(L)
    return s.select((F.col("doc_id") + 1).cast("int").alias("junction_no"), F.col("doc_id").cast("string").alias("contig"), F.when(F.col("doc_id") % 2 == 1, "-").otherwise("+").alias("strand"), F.lit(11).cast(L).alias("left_start1"), F.lit(40).cast(L).alias("left_end1"), (n - 60).alias("right_start1"), (n - 31).alias("right_end1"))


def _doc_contigs(spark, sf_dir):
    return views.sequences(spark, sf_dir).select(F.col("doc_id").cast("string").alias("contig"), "seq")


_JUNC = f"junc AS (SELECT doc_id + 1 AS junction_no, CASE WHEN doc_id % 2 = 1 THEN reverse(translate(j, 'ACGT', 'TGCA')) ELSE j END AS seq FROM (SELECT doc_id, substr(seq, 11, 30) || substr(seq, CAST(length(seq) - 60 AS BIGINT), 30) AS j FROM seqs WHERE length(seq) >= 100))"


@sql(f"WITH {SEQS}, {_JUNC} SELECT CAST(junction_no AS INTEGER) AS junction_no, seq FROM junc")
def junction_sequences(spark, sf_dir):
    chunks = mapping.chunk_reference(_doc_contigs(spark, sf_dir), 256, 64)
    return junctions.sequences(_doc_junctions(spark, sf_dir), chunks, 256).select("junction_no", "seq")


@sql(f"WITH {ALN}, {SEQS} SELECT read_id, hit_no, CAST(start0 AS INTEGER) AS junction_no, CASE WHEN (start0 - 1) % 2 = 1 THEN '-' ELSE '+' END AS gene_strand FROM aln JOIN seqs ON doc_id = start0 - 1 AND length(seq) >= 100")
def junction_lookup(spark, sf_dir):
    hits = views.alignments(spark, sf_dir).select("read_id", "hit_no", F.col("start0").cast("int").alias("junction_no"))
    return merging.junction_by_number(hits, _doc_junctions(spark, sf_dir).select("junction_no", F.col("strand").alias("gene_strand")))


_CODON = "list_value(substr('ACGT', p_partkey % 4 + 1, 1), substr('ACGT', p_partkey // 4 % 4 + 1, 1), substr('ACGT', p_partkey // 16 % 4 + 1, 1))"
_PUT = f"(SELECT string_agg(base || {_AMINO}, ',' ORDER BY base) FROM (SELECT base, list_transform(range(1, 4), lambda i: CASE WHEN i = p_size % 3 + 1 THEN CASE WHEN p_partkey % 5 = 0 THEN translate(base, 'ACGT', 'TGCA') ELSE base END ELSE t.c[i] END) AS c FROM (VALUES ('A'), ('C'), ('G'), ('T')) v(base)))"


@sql(f"WITH t AS (SELECT p_partkey, p_size, {_CODON} AS c FROM part) SELECT p_partkey, {_AMINO} AS amino, {_PUT} AS changes FROM t")
def codon_changes(spark, sf_dir):
    k = F.col("p_partkey")
    letter = lambda d: F.substring(F.lit("ACGT"), (F.floor(k / d) % 4 + 1).cast("int"), F.lit(1))
    rows = views.table(spark, sf_dir, "part").select(k, F.concat(letter(1), letter(4), letter(16)).alias("codon"), (F.col("p_size") % 3).cast("int").alias("codon_pos"), F.when(k % 5 == 0, "-").otherwise("+").alias("strand"))
    return variants.codon_changes(rows).select("p_partkey", "amino", F.array_join(F.transform("changes", lambda x: F.concat(x["base"], x["amino"])), ",").alias("changes"))


_LOG = "(lgamma({n} + 1.0) - lgamma({k} + 1.0) - lgamma(({n}) - ({k}) + 1.0))"
_TERM = f"exp({_LOG.format(n='p_size', k='k')} + {_LOG.format(n='100 - p_size', k='30 - k')} - {_LOG.format(n='100', k='30')})"


@sql(f"""SELECT p_partkey, round(least(1.0, coalesce(list_sum(list_transform(range(greatest(p_partkey % 20, p_size - 70, 0), least(p_size, 30) + 1), lambda k: {_TERM})), 0.0)), 6) AS tail FROM part""")
def hypergeometric_rows(spark, sf_dir):
    p = views.table(spark, sf_dir, "part")
    return p.select("p_partkey", F.round(stats.hypergeometric_tails(F.col("p_partkey") % 20, F.col("p_size"), F.lit(30), F.lit(100)), 6).alias("tail"))


@sql("""SELECT p_partkey, round(CASE WHEN p_partkey % 30 = 0 THEN 0.0 ELSE log10(list_sum(list_transform(range(p_partkey % 30, p_partkey % 30 + 400), lambda k: exp(k * ln(p_size / 2.0) - p_size / 2.0 - lgamma(k + 1.0))))) END, 6) + 0.0 AS log_tail FROM part""")
def poisson_rows(spark, sf_dir):
    p = views.table(spark, sf_dir, "part")
    return p.select("p_partkey", (F.round(stats.log10_poisson_tails(F.col("p_partkey") % 30, F.col("p_size") / 2), 6) + 0.0).alias("log_tail"))


# -- operators of hits and features --------------------------------------------


@sql(f"WITH {ALN}, t AS (SELECT read_id, hit_no, start0, start0 + aln_len - 25 AS end0 FROM aln) SELECT read_id, hit_no, 'drop' AS kind, start0, end0 FROM t WHERE end0 >= start0 UNION ALL SELECT read_id, hit_no, 'swap', least(start0, end0), greatest(start0, end0) FROM t UNION ALL SELECT read_id, hit_no, 'truncate', start0, greatest(start0, end0) FROM t")
def repaired_intervals(spark, sf_dir):
    t = views.alignments(spark, sf_dir).select("read_id", "hit_no", "start0", (F.col("start0") + F.col("aln_len") - 25).alias("end0"))
    return merging.union([al.invalid_intervals(t, m).select("read_id", "hit_no", F.lit(m).alias("kind"), "start0", "end0") for m in ("drop", "swap", "truncate")])


@sql(f"WITH {FEAT} SELECT feature_id FROM feat WHERE contig = 'N' AND start1 >= 100 AND end1 <= 1500 AND lower(transcript) = 'promo'")
def features_in_region(spark, sf_dir):
    return al.inside_region(views.features(spark, sf_dir).withColumn("ftype", F.col("transcript")), "N", 100, 1500, "Promo").select("feature_id")


_DELTA = "SELECT read_id FROM (SELECT read_id, mm, lead(mm) OVER (PARTITION BY read_id ORDER BY mm) AS nx, row_number() OVER (PARTITION BY read_id ORDER BY mm) AS rk FROM aln) WHERE rk = 1 AND (nx IS NULL OR nx - mm > 1)"


@sql(f"WITH {ALN}, o AS ({_ORDERS}) SELECT read_id, 'hit' AS kind FROM o WHERE read_id NOT IN (SELECT read_id FROM aln) UNION ALL SELECT read_id, 'perfect' FROM o WHERE read_id NOT IN (SELECT read_id FROM aln WHERE mm = 0) UNION ALL SELECT read_id, 'delta' FROM o WHERE read_id NOT IN ({_DELTA})")
def progressive_reads(spark, sf_dir):
    reads, hits = _named(spark, sf_dir).select("read_id"), views.alignments(spark, sf_dir)
    return merging.union([al.progressive(reads, hits, m, 1).withColumn("kind", F.lit(m)) for m in ("hit", "perfect", "delta")])


_BINS = "SELECT CAST(ceil(score / 5.0) * 5 AS BIGINT) AS bin, count(*) AS freq FROM aln GROUP BY 1"


@sql(f"WITH {ALN}, h AS ({_BINS}) SELECT bin, CAST(2 * freq AS BIGINT) AS freq, round(freq / sum(freq) OVER (), 6) AS share FROM h")
def added_histograms(spark, sf_dir):
    h = al.histogram(views.alignments(spark, sf_dir), F.col("score"), 5)
    return al.relative(al.add_histograms([h, h])).withColumn("share", F.round("share", 6))


@sql(f"WITH {ALN}, h AS ({_BINS}) SELECT CAST(ceil(bin / 20.0) * 20 AS BIGINT) AS bin, CAST(sum(freq) AS BIGINT) AS freq FROM h GROUP BY 1")
def rebinned_histogram(spark, sf_dir):
    return al.rebinned(al.histogram(views.alignments(spark, sf_dir), F.col("score"), 5), 20)


@sql("SELECT l_orderkey, l_linenumber, s_name AS contig FROM lineitem LEFT JOIN (SELECT * FROM supplier WHERE s_suppkey % 3 > 0) ON s_suppkey = l_suppkey")
def contig_names(spark, sf_dir):
    names = views.table(spark, sf_dir, "supplier").where("s_suppkey % 3 > 0").select(F.col("s_suppkey").alias("contig_idx"), F.col("s_name").alias("contig"))
    hits = views.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("contig_idx"))
    return al.named_contigs(hits, names).drop("contig_idx")


@sql(f"WITH {ALN} SELECT contig, start0, strand, read_id, hit_no, row_number() OVER (PARTITION BY contig ORDER BY start0, strand, read_id, hit_no) AS place FROM aln")
def hits_in_order(spark, sf_dir):
    hits = al.in_reference_order(views.alignments(spark, sf_dir).select("contig", "start0", "strand", "read_id", "hit_no"))
    return hits.withColumn("place", F.row_number().over(Window.partitionBy("contig").orderBy("start0", "strand", "read_id", "hit_no")).cast(L))


_PAIRED = "length(replace(replace(array_to_string(list_transform(range(1, n + 1), lambda i: CASE WHEN a[i] <> b[i] THEN 'x' ELSE '=' END), ''), 'xx', 'x'), '=', ''))"


@sql(f"""WITH {SEQS}, t AS (SELECT doc_id, string_split(left(seq, length(seq) // 2), '') AS a, string_split(right(seq, length(seq) // 2), '') AS b, length(seq) // 2 AS n FROM seqs WHERE length(seq) > 1)
SELECT doc_id, CAST(list_sum(list_transform(range(1, n + 1), lambda i: CASE WHEN a[i] <> b[i] THEN 1 ELSE 0 END)) AS INTEGER) AS plain, CAST({_PAIRED} AS INTEGER) AS paired FROM t""")
def paired_mismatches(spark, sf_dir):
    n = F.floor(F.length("seq") / 2).cast("int")
    a, b = F.left("seq", n), F.right("seq", n)
    return views.sequences(spark, sf_dir).where("length(seq) > 1").select("doc_id", color.mismatches(a, b).alias("plain"), color.mismatches_paired(a, b).alias("paired"))


# -- mapping chain -------------------------------------------------------------

_HITS = f"{ALN}, {SEQS}, spans AS (SELECT read_id, hit_no, strand, substr(seq, start0 + 1, 26) AS s FROM aln JOIN seqs ON doc_id = read_id % 97)"


@sql(f"WITH {_HITS} SELECT read_id, hit_no, s AS ref_seq, CASE WHEN strand = '-' THEN reverse(c) ELSE c END AS ref_colors FROM (SELECT *, array_to_string(list_transform(range(1, 26), lambda i: xor(instr('ACGT', s[i]) - 1, instr('ACGT', s[i + 1]) - 1)), '') AS c FROM spans WHERE length(s) = 26)")
def reference_spans(spark, sf_dir):
    hits = views.alignments(spark, sf_dir).select("read_id", "hit_no", (F.col("read_id") % 97).cast("string").alias("contig"), F.col("start0").alias("pos0"), "strand")
    return chain.with_reference(hits, _doc_contigs(spark, sf_dir), 26).select("read_id", "hit_no", "ref_seq", "ref_colors")


def tiles(spark, sf_dir, length):
    """Reads of ``length`` letters, the first of which is the primer, tiled over whole benchmark items."""
    items = views.sequences(spark, sf_dir, "benchmark", "item_id").where(f"length(seq) >= {length}")
    offsets = F.expr(f"array_distinct(array_append(sequence(0, length(seq) - {length}, {length - 1}), length(seq) - {length}))")
    rows = items.select("item_id", "seq", F.explode(offsets).alias("at")).select(F.concat_ws(":", F.col("item_id").cast("string"), F.col("at").cast("string")).alias("read_id"), F.substring(F.col("seq"), F.col("at") + 1, F.lit(length)).alias("seq"))
    return rows.select("read_id", F.substring("seq", 1, 1).alias("primer"), color.encode_colors(F.col("seq")).alias("colors"))


def _colors(seq: str) -> str:
    return f"array_to_string(list_transform(range(1, length({seq})), lambda i: xor(instr('ACGT', string_split({seq}, '')[i]) - 1, instr('ACGT', string_split({seq}, '')[i + 1]) - 1)), '')"


def tiled(read: int) -> str:
    return f"""items AS (SELECT item_id, {SEQ} AS seq FROM benchmark), offs AS (SELECT item_id, seq, unnest(list_distinct(list_append(range(0, length(seq) - {read} + 1, {read - 1}), length(seq) - {read}))) AS ofs FROM items WHERE length(seq) >= {read}),
tile AS (SELECT item_id || ':' || ofs AS read_id, substr(seq, ofs + 1, {read}) AS s FROM offs)"""


def mapped(length: int, reads: str, refs: str, most: int = 2) -> str:
    """Hits of reads (table tile: read_id, s) by their first ``length`` bases behind the primer, in the table refs (contig, seq)."""
    n = length - 1
    cuts = [round(i * n / (most + 1)) for i in range(most + 2)]
    blocks = ", ".join(f"({i}, {a}, {b - a})" for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)))
    return f"""{SEQS}, {reads}, tcol AS (SELECT read_id, s, {_colors('s')} AS colors FROM tile),
one AS (SELECT read_id, s[2] AS first, substr(colors, 2, {n}) AS q, colors FROM tcol), both_ AS (SELECT read_id, '+' AS strand, first, q FROM one UNION ALL SELECT read_id, '-', translate(first, 'ACGT', 'TGCA'), reverse(q) FROM one),
refs AS ({refs}), rlet AS (SELECT contig, seq, string_split(seq, '') AS l FROM refs), rcol AS (SELECT contig, seq, array_to_string(list_transform(range(1, length(seq)), lambda i: xor(instr('ACGT', l[i]) - 1, instr('ACGT', l[i + 1]) - 1)), '') AS c FROM rlet),
blocks AS (SELECT * FROM (VALUES {blocks}) t(block, a, w)), win AS (SELECT contig, p, substr(seq, p + 1, 1) AS base, substr(seq, p + {length}, 1) AS last, substr(c, p + 1, {n}) AS ref FROM (SELECT contig, seq, c, unnest(range(0, length(seq) - {n})) AS p FROM rcol WHERE length(seq) >= {length})),
cand AS (SELECT DISTINCT read_id, contig, p, b.strand, q, ref, first, CASE WHEN b.strand = '+' THEN base ELSE last END AS base FROM (SELECT b.*, block, substr(q, a + 1, w) AS key FROM both_ b, blocks) b JOIN (SELECT w_.*, block, substr(ref, a + 1, w) AS key FROM win w_, blocks) r USING (block, key)),
hits AS (SELECT * FROM (SELECT read_id, contig, CAST(p AS BIGINT) AS pos0, strand, CAST(hamming(q, ref) + CASE WHEN first = base THEN 0 ELSE 1 END AS INTEGER) AS mm FROM cand) WHERE mm <= {most})"""


ORACLES["map_reads"] = f"WITH {mapped(26, tiled(27), 'SELECT CAST(doc_id AS VARCHAR) AS contig, seq FROM seqs')} SELECT read_id, contig, pos0, strand, mm FROM hits"


_JSEQ = f"{_JUNC}, tile AS (SELECT CAST(junction_no AS VARCHAR) AS read_id, substr(seq, 18, 27) AS s FROM junc)"


@sql(f"""WITH {mapped(26, _JSEQ, 'SELECT CAST(junction_no AS VARCHAR) AS contig, seq FROM junc')}
SELECT read_id, CAST(contig AS INTEGER) AS junction_no, pos0 AS start0, strand, mm, CAST(26 - 2 * mm AS BIGINT) AS score FROM hits""")
def junction_hits(spark, sf_dir):
    """Reads from the middle of each document's junction, mapped onto all junctions."""
    docs = cut(views.sequences(spark, sf_dir))  # else the texts are cleaned for each of the three readings
    chunks = mapping.chunk_reference(docs.select(F.col("doc_id").cast("string").alias("contig"), "seq"), 256, 64)
    seqs = cut(junctions.sequences(_doc_junctions(spark, sf_dir, docs), chunks, 256).select("junction_no", "seq"))
    read = F.substring("seq", 18, 27)
    reads = seqs.select(F.col("junction_no").cast("string").alias("read_id"), F.left(read, F.lit(1)).alias("primer"), color.encode_colors(read).alias("colors"))
    return chain.map_to_junctions(reads, seqs, 26, 2).drop("aln_len")


def extended(source: str, key: str, adjacent: bool = True) -> str:
    """The best prefix of two colour strings (x, y) of each row of ``source``, position by position."""
    bad = "substr(x, i + 1, 1) <> substr(y, i + 1, 1)"
    code = lambda t, i: f"TRY_CAST(substr({t}, {i}, 1) AS INTEGER)"
    fits = f"({bad} AND run > 0 AND xor({code('x', 'i + 1')}, {code('x', 'i')}) = xor({code('y', 'i + 1')}, {code('y', 'i')}))"
    score, mm = f"(score + CASE WHEN {fits} THEN 1 WHEN {bad} THEN -1 ELSE 1 END)", f"(mm + CASE WHEN {fits} THEN 0 WHEN {bad} THEN 1 ELSE 0 END)"
    return f"""ext AS (SELECT {key}, x, y, 0 AS i, 0 AS score, 0 AS best, 0 AS aln, 0 AS mm, 0 AS mm_best, 0 AS run, 0 AS n_pairs FROM {source}
  UNION ALL SELECT {key}, x, y, i + 1, {score}, greatest(best, {score}), CASE WHEN {score} > best THEN i + 1 ELSE aln END, {mm}, CASE WHEN {score} > best THEN {mm} ELSE mm_best END, CASE WHEN {fits} OR NOT ({bad}) THEN 0 ELSE run + 1 END, n_pairs + CASE WHEN {fits} THEN 1 ELSE 0 END
  FROM ext WHERE i < least(length(x), length(y)))"""


_PIECES = f"{SEQS}, halves AS (SELECT doc_id, piece, {_colors('a')} AS x, {_colors('b')} AS y FROM (SELECT doc_id, piece, substr(seq, 50 * piece + 1, 51) AS a, substr(seq, 50 * piece + 51, 51) AS b FROM (SELECT doc_id, seq, unnest(range(0, (length(seq) - 1) // 50)) AS piece FROM seqs WHERE length(seq) > 50)))"
ORACLES["extend_score"] = f"WITH RECURSIVE {_PIECES}, {extended('halves', 'doc_id, piece')} SELECT doc_id, CAST(piece AS INTEGER) AS piece, CAST(best AS BIGINT) AS score, CAST(aln AS BIGINT) AS aln_len, CAST(mm_best AS BIGINT) AS mm, CAST(n_pairs AS BIGINT) AS n_pairs FROM ext WHERE i = least(length(x), length(y))"

_EXTENDED = f"""WITH RECURSIVE {mapped(26, tiled(51), 'SELECT CAST(doc_id AS VARCHAR) AS contig, seq FROM seqs')}, placed AS (SELECT h.read_id, h.contig, h.strand, CASE WHEN h.strand = '-' THEN pos0 - 24 ELSE pos0 END AS pos0, substr(o.colors, 2, 49) AS x FROM hits h JOIN one o USING (read_id)),
refd AS (SELECT p.*, substr(r.c, p.pos0 + 1, 49) AS y0 FROM placed p JOIN rcol r USING (contig) WHERE p.pos0 >= 0 AND p.pos0 + 50 <= length(r.seq)), cols AS (SELECT read_id, contig, strand, pos0, x, CASE WHEN strand = '-' THEN reverse(y0) ELSE y0 END AS y FROM refd),
{extended('cols', 'read_id, contig, strand, pos0')}, done AS (SELECT read_id, contig, strand, pos0, CAST(best AS BIGINT) AS score, CAST(aln AS BIGINT) AS aln_len, CAST(mm_best AS BIGINT) AS mm FROM ext WHERE i = 49)"""


def _extended_hits(spark, sf_dir):
    return chain.map_and_extend(tiles(spark, sf_dir, 51), _doc_contigs(spark, sf_dir), 26, 50, 2).select("read_id", "contig", "strand", "pos0", "score", "aln_len", "mm")


@sql(f"{_EXTENDED} SELECT * FROM done")
def extended_hits(spark, sf_dir):
    return _extended_hits(spark, sf_dir)


@sql(f"{_EXTENDED}, ranked AS (SELECT *, row_number() OVER w AS rk, lead(score) OVER w AS second_score, count(*) OVER (PARTITION BY read_id) AS n_hits FROM done WINDOW w AS (PARTITION BY read_id ORDER BY score DESC, contig, pos0, strand)) SELECT read_id, contig, strand, pos0, score, aln_len, mm, second_score, n_hits FROM ranked WHERE rk = 1 AND score - coalesce(second_score, 19) >= 4")
def mapped_unique(spark, sf_dir):
    """The whole chain: reads onto documents, extension, unique best."""
    return chain.unique_placements(_extended_hits(spark, sf_dir), 4, 20).drop("start0")


ORACLES["random_hits"] = f"WITH {ALN}, r AS (SELECT *, row_number() OVER (PARTITION BY read_id ORDER BY md5(concat_ws('|', '0', read_id, contig, start0, strand, hit_no, aln_len)), contig, start0, strand, hit_no, aln_len) AS rk FROM aln) SELECT read_id, hit_no, contig, strand, start0, score FROM r WHERE rk = 1 AND score >= 10"
ORACLES["indel_clusters"] = f"""WITH RECURSIVE {ALN}, t AS (SELECT contig, start0 AS pos, score AS size, aln_len AS r_pos, score AS f_pos FROM aln WHERE mm = 3), p AS (SELECT contig, pos, row_number() OVER (PARTITION BY contig ORDER BY pos) AS k FROM (SELECT DISTINCT contig, pos FROM t)),
w AS (SELECT contig, pos, k, pos AS opened FROM p WHERE k = 1 UNION ALL SELECT p.contig, p.pos, p.k, CASE WHEN p.pos > w.opened + 2 THEN p.pos ELSE w.opened END FROM w JOIN p ON p.contig = w.contig AND p.k = w.k + 1)
SELECT contig, opened AS start, max(pos) AS "end", count(DISTINCT (r_pos, f_pos)) AS n_unique, count(*) AS n_total, min(size) AS min_size, max(size) AS max_size FROM t JOIN w USING (contig, pos) GROUP BY contig, opened"""


_JHITS = f"""{ALN}, {FEAT}, jn AS (SELECT feature_id AS junction_no, contig, CASE WHEN f_strand = '-' THEN '-' ELSE '+' END AS gene, start1 AS ls, end1 + 50 AS rs, feature_id % 2 = 0 AS known FROM feat),
jh AS (SELECT read_id, start0 AS junction_no, strand, (read_id + hit_no) % 30 AS p, 15 + aln_len % 15 AS n, mm, 15 + aln_len % 15 - 2 * mm AS score FROM aln WHERE hit_no % 2 = 1),
ju AS (SELECT h.*, j.contig, gene, ls, rs, known, CASE WHEN gene = '-' THEN 60 - p - n ELSE p END AS f FROM jh h JOIN jn j USING (junction_no) WHERE strand = '+'),
jg AS (SELECT *, CASE WHEN f < 30 THEN ls - 1 + f ELSE rs - 1 + f - 30 END AS s0, CASE WHEN f + n - 1 < 30 THEN ls - 1 + f + n - 1 ELSE rs - 1 + f + n - 1 - 30 END AS e0, score - CASE WHEN known THEN 2 ELSE 4 END AS sc, greatest(0, least(f + n, 30) - f) AS on_left FROM ju),
jk AS (SELECT read_id, contig, gene AS strand, s0 AS start0, e0 AS end0, n AS aln_len, sc AS score, mm, junction_no FROM jg WHERE on_left >= 4 AND n - on_left >= 4 AND sc >= 10),
every AS (SELECT read_id, contig, strand, start0, end0, aln_len, score, mm, CAST(NULL AS BIGINT) AS junction_no FROM aln WHERE score >= 10 UNION ALL SELECT * FROM jk)"""


@sql(f"""WITH {_JHITS} SELECT * FROM every a WHERE NOT EXISTS (SELECT 1 FROM every b WHERE a.read_id = b.read_id AND a.contig = b.contig AND a.strand = b.strand AND (a.start0 = b.start0 OR a.end0 = b.end0) AND (a.junction_no IS NULL) <> (b.junction_no IS NULL)
AND (b.score > a.score OR (b.score = a.score AND b.junction_no IS NULL)))""")
def genomic_and_junction_hits(spark, sf_dir):
    hits, f = views.alignments(spark, sf_dir), views.features(spark, sf_dir)
    j = f.select(F.col("feature_id").cast("int").alias("junction_no"), F.col("contig").alias("contig_id"), F.when(F.col("f_strand") == "-", "-").otherwise("+").alias("strand"), F.col("start1").alias("left_start1"), (F.col("start1") + 29).alias("left_end1"), (F.col("end1") + 50).alias("right_start1"), (F.col("end1") + 79).alias("right_end1"), (F.col("feature_id") % 2 == 0).alias("is_known"))
    n = 15 + F.col("aln_len") % 15
    on = hits.where("hit_no % 2 = 1").select("read_id", F.col("start0").cast("int").alias("junction_no"), ((F.col("read_id") + F.col("hit_no")) % 30).alias("start0"), n.alias("aln_len"), "strand", "mm", (n - 2 * F.col("mm")).alias("score"))
    out = al.merge_junction_hits(hits.drop("end0", "hit_no"), on, j, 2, 4, 10)
    return out.withColumn("junction_no", F.col("junction_no").cast(L))


_INTER = f"{FEAT}, pts AS (SELECT DISTINCT CASE l_suppkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END AS contig, l_partkey * 3 AS pos0 FROM lineitem)"


@sql(f"""WITH {_INTER} SELECT contig, pos0, l AS left_end0, pos0 - l AS left_steps, r AS right_start0, r - pos0 AS right_steps FROM (SELECT contig, pos0, (SELECT max(end1 - 1) FROM feat f WHERE f.contig = p.contig AND end1 - 1 < pos0) AS l, (SELECT min(start1 - 1) FROM feat f WHERE f.contig = p.contig AND start1 - 1 > pos0) AS r FROM pts p)""")
def flanking_exons(spark, sf_dir):
    s = F.col("l_suppkey") % 3
    points = views.table(spark, sf_dir, "lineitem").select(F.when(s == 0, "A").when(s == 1, "N").otherwise("R").alias("contig"), (F.col("l_partkey") * 3).alias("pos0"))
    marks = views.features(spark, sf_dir).select("contig", (F.col("start1") - 1).alias("start0"), (F.col("end1") - 1).alias("end0"))
    return variants.flanking_exons(points, marks, 1 << 12)


# -- formats: written to the shared folder, read back -------------------------


def _path(spark, name):
    import uuid

    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _written(spark, lines, name):
    path = _path(spark, name)
    writers.write_lines(lines, path)
    return path


def _fasta(spark, sf_dir):
    s = views.sequences(spark, sf_dir).select(F.concat(F.lit("doc"), F.col("doc_id").cast("string"), F.lit(" x")).alias("header"), "seq")
    return _written(spark, writers.fasta_lines(s, 70), "fasta")


@sql(f"WITH {SEQS} SELECT 'doc' || doc_id AS contig_id, 'doc' || doc_id || ' x' AS header, sha256(seq) AS seq_sha256 FROM seqs")
def fasta_scan(spark, sf_dir):
    return readers.fasta(spark, _fasta(spark, sf_dir)).select("contig_id", "header", F.sha2("seq", 256).alias("seq_sha256"))


@sql(f"WITH {SEQS} SELECT count(*) AS n_contigs, CAST(sum(length(seq)) AS BIGINT) AS bases FROM seqs")
def fasta_totals(spark, sf_dir):
    return readers.totals(readers.contigs(spark, _fasta(spark, sf_dir)))


@sql(f"WITH {SEQS} SELECT 'doc' || doc_id || ' x' AS header, length(seq) AS n, 'subset' AS kind FROM seqs WHERE doc_id IN (SELECT doc_id FROM labels) UNION ALL SELECT 'doc' || doc_id || ' x', length(seq), 'prefix' FROM seqs WHERE starts_with('doc' || doc_id, 'doc1') UNION ALL SELECT 'doc' || doc_id || ' x', length(seq), 'exact' FROM seqs WHERE doc_id = 7")
def fasta_fetch(spark, sf_dir):
    s = cut(readers.fasta(spark, _fasta(spark, sf_dir)).select("header", "seq"))
    wanted = views.table(spark, sf_dir, "labels").select(F.concat(F.lit("doc"), F.col("doc_id").cast("string"), F.lit(" x")).alias("header"))
    parts = {"subset": readers.subset(s, wanted), "prefix": readers.fetch(s, "doc1", prefix=True), "exact": readers.fetch(s, "DOC7 X")}
    return merging.union([p.select("header", F.length("seq").cast(L).alias("n"), F.lit(k).alias("kind")) for k, p in parts.items()])


def _csfasta(spark, sf_dir):
    key = [F.col(c).cast("string") for c in ("l_suppkey", "l_partkey", "l_orderkey")]
    colors = F.translate(F.concat_ws("", *[F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey")]), "456789", "012301")
    line = F.concat(F.lit(">"), F.concat_ws("_", *key), F.lit("_L"), F.col("l_linenumber").cast("string"), F.lit("\nT"), colors)
    return _written(spark, views.table(spark, sf_dir, "lineitem").select(line.alias("value")), "csfasta")


_CS = "cs AS (SELECT l_suppkey || '_' || l_partkey || '_' || l_orderkey || '_L' || l_linenumber AS read_id, CAST(l_suppkey AS INTEGER) AS panel, CAST(l_partkey AS INTEGER) AS x, CAST(l_orderkey AS INTEGER) AS y, 'L' || l_linenumber AS tag, translate(l_orderkey::VARCHAR || l_partkey::VARCHAR || l_suppkey::VARCHAR, '456789', '012301') AS colors FROM lineitem)"


@sql(f"WITH {_CS} SELECT *, 'T' AS primer FROM cs")
def csfasta_scan(spark, sf_dir):
    return readers.csfasta(spark, _csfasta(spark, sf_dir))


@sql(f"WITH {_CS}, n AS (SELECT *, row_number() OVER (ORDER BY panel, x, y, tag, read_id) AS ordinal FROM cs) SELECT read_id, ordinal FROM n WHERE ordinal BETWEEN 100 AND 3000")
def csfasta_range(spark, sf_dir):
    return readers.csfasta(spark, _csfasta(spark, sf_dir), 100, 3000).select("read_id", F.col("ordinal").cast(L).alias("ordinal"))


def _distinct_hits(spark, sf_dir):
    a = views.alignments(spark, sf_dir)
    return a.select(F.col("read_id").cast("string").alias("read_id"), (F.ascii("contig") % 7).cast("int").alias("contig_idx"), F.col("start0").alias("pos0"), "strand", F.col("hit_no").cast("int").alias("read_start"), F.col("aln_len").cast("int").alias("aln_len"), F.col("score").cast("int").alias("score"), F.col("mm").cast("int").alias("mm"))


_MAXHITS = "SELECT CAST(read_id AS VARCHAR) AS read_id, CAST(ascii(contig) % 7 AS INTEGER) AS contig_idx, start0 AS pos0, strand, CAST(mm AS INTEGER) AS mm"


@sql(f"WITH {ALN} {_MAXHITS} FROM aln")
def hit_list_scan(spark, sf_dir):
    pos = F.when(F.col("strand") == "-", F.concat(F.lit("-"), F.col("pos0").cast("string"))).otherwise(F.col("pos0").cast("string"))
    one = F.concat(F.col("contig_idx").cast("string"), F.lit("_"), pos, F.lit("."), F.col("mm").cast("string"))
    lines = _distinct_hits(spark, sf_dir).groupBy("read_id").agg(F.collect_list(one).alias("h")).select(F.concat(F.lit(">"), F.col("read_id"), F.lit(","), F.array_join("h", ","), F.lit("\nT0")).alias("value"))
    return readers.hit_lists(spark, _written(spark, lines, "hits"))


@sql(f"WITH {ALN} {_MAXHITS}, CAST(hit_no AS INTEGER) AS read_start, CAST(aln_len AS INTEGER) AS aln_len, CAST(score AS INTEGER) AS score, concat_ws('.', mm, hit_no) AS va, hit_no || ':' || mm AS ins_read, 0 AS split_no FROM aln")
def max_scan(spark, sf_dir):
    one = lambda a, b: F.array(F.struct(a.alias("pos"), b.alias("len")))
    rows = _distinct_hits(spark, sf_dir).withColumn("va", F.array("mm", "read_start")).withColumn("ins_read", one(F.col("read_start"), F.col("mm"))).withColumn("ins_ref", F.filter("ins_read", lambda x: F.lit(False)))
    back = readers.alignment_lists(spark, _written(spark, writers.alignment_lines(rows, with_pairs=True), "max"))
    return back.withColumn("va", F.array_join(F.col("va").cast("array<string>"), ".")).withColumn("ins_read", F.array_join(F.transform("ins_read", lambda x: F.concat_ws(":", x["pos"].cast("string"), x["len"].cast("string"))), ";")).drop("ins_ref")


def _gff(spark, sf_dir):
    f = views.features(spark, sf_dir)
    none = F.lit(None).cast("string")
    text = F.concat(F.lit('gene_id "'), F.col("gene"), F.lit('"; transcript_id "'), F.col("transcript"), F.lit('";'))
    return f.select(F.col("contig").alias("contig_id"), F.lit("src").alias("source"), F.when(F.col("feature_id") % 4 == 0, "CDS").otherwise("exon").alias("ftype"), (F.col("start1") % 300 + 1).alias("start1"), (F.col("start1") % 300 + 40).alias("end1"), none.alias("score"), F.when(F.col("f_strand") == "-", "-").otherwise("+").alias("strand"), none.alias("phase"), text.alias("attributes"))


_GFF = f"{FEAT}, gff AS (SELECT contig AS contig_id, CASE WHEN feature_id % 4 = 0 THEN 'CDS' ELSE 'exon' END AS ftype, start1 % 300 + 1 AS start1, start1 % 300 + 40 AS end1, CASE WHEN f_strand = '-' THEN '-' ELSE '+' END AS strand, gene, transcript FROM feat)"


@sql(f"""WITH {_GFF} SELECT contig_id, 'src' AS source, ftype, greatest(1, start1 - 5) AS start1, end1 + 5 AS end1, CAST(NULL AS VARCHAR) AS score, strand, CAST(NULL AS VARCHAR) AS phase, 'gene_id "' || gene || '"; transcript_id "' || transcript || '";' AS attributes FROM gff""")
def gff_scan(spark, sf_dir):
    return readers.features(spark, _written(spark, writers.feature_lines(_gff(spark, sf_dir)), "gff"), 5)


@sql(f"WITH {_GFF} SELECT contig_id, strand, start1, end1, string_agg(DISTINCT gene, ',' ORDER BY gene) AS genes, string_agg(DISTINCT transcript, ',' ORDER BY transcript) AS transcripts FROM gff WHERE ftype = 'exon' GROUP BY contig_id, strand, start1, end1")
def unique_exon_scan(spark, sf_dir):
    e = readers.unique_exons(readers.features(spark, _written(spark, writers.feature_lines(_gff(spark, sf_dir)), "gff")))
    return e.select("contig_id", "strand", "start1", "end1", F.array_join("gene_ids", ",").alias("genes"), F.array_join("transcript_ids", ",").alias("transcripts"))


def _dump(spark, sf_dir):
    k = F.col("p_partkey")
    s = lambda c: c.cast("string")
    a, b = k * 10, k * 10 + 200
    fields = [F.lit("1"), F.concat(F.lit("NM_"), s(k)), F.col("p_brand"), F.when(k % 2 == 0, "+").otherwise("-"), s(a), s(b + 100), s(a + 10), s(b + 50), F.lit("2"), F.concat(s(a), F.lit(","), s(b), F.lit(",")), F.concat(s(a + 90), F.lit(","), s(b + 100), F.lit(",")), F.lit("0"), F.col("p_type"), F.lit("cmpl"), F.lit("cmpl"), F.lit("0,1,")]
    line = F.when(k % 50 == 0, F.lit("1\tbroken")).otherwise(F.concat_ws("\t", *fields))
    return _written(spark, views.table(spark, sf_dir, "part").select(line.alias("value")), "dump")


_DUMP = "d AS (SELECT p_partkey AS k, 'NM_' || p_partkey AS name, p_brand AS contig_id, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand, p_type AS gene_id, p_partkey * 10 AS a, p_partkey * 10 + 200 AS b FROM part WHERE p_partkey % 50 <> 0)"


@sql(f"WITH {_DUMP} SELECT contig_id, strand, gene_id, name AS transcript_id, 0 AS exon_no, a + 1 AS start1, a + 90 AS end1, 0 AS frame FROM d UNION ALL SELECT contig_id, strand, gene_id, name, 1, b + 1, b + 100, 1 FROM d")
def transcript_scan(spark, sf_dir):
    return readers.transcript_exons(readers.transcripts(spark, _dump(spark, sf_dir)))


@sql(f"""WITH {_DUMP}, x AS (SELECT *, a + 1 AS s1, a + 90 AS e1, b + 1 AS s2, b + 100 AS e2, a + 11 AS cs, b + 50 AS ce, 'gene_id "' || gene_id || '"; transcript_id "' || name || '"; ' AS attributes FROM d),
r AS (SELECT *, 'exon' AS ftype, s1 AS start1, e1 AS end1, CAST(NULL AS VARCHAR) AS phase FROM x UNION ALL SELECT *, 'exon', s2, e2, NULL FROM x UNION ALL SELECT *, 'CDS', greatest(s1, cs), least(e1, ce), '0' FROM x UNION ALL SELECT *, 'CDS', greatest(s2, cs), least(e2, ce), '2' FROM x
  UNION ALL SELECT *, 'start_codon', CASE WHEN strand = '+' THEN cs ELSE ce - 2 END, CASE WHEN strand = '+' THEN cs + 2 ELSE ce END, NULL FROM x) SELECT contig_id, ftype, start1, end1, strand, phase, attributes FROM r""")
def gtf_from_transcripts(spark, sf_dir):
    return writers.gtf_rows(readers.transcripts(spark, _dump(spark, sf_dir))).select("contig_id", "ftype", "start1", "end1", "strand", "phase", "attributes")


@sql("SELECT CAST(p_partkey AS VARCHAR) AS id, p_brand AS contig, CASE WHEN p_size % 2 = 0 THEN '-' ELSE '+' END AS strand, CASE WHEN p_size % 2 = 0 THEN 'T/C' ELSE 'A/G' END AS alleles FROM part")
def variant_scan(spark, sf_dir):
    line = F.concat_ws("\t", F.col("p_partkey").cast("string"), F.lit("x"), "p_brand", F.when(F.col("p_size") % 2 == 0, "-").otherwise("+"), F.lit("A/G"))
    path = _written(spark, views.table(spark, sf_dir, "part").select(line.alias("value")), "variants")
    return readers.variants(spark, path, {"id": 0, "contig": 2, "strand": 3, "alleles": 4})


@sql("SELECT n_name AS c0, CAST(n_nationkey AS VARCHAR) AS c1 FROM nation")
def column_scan(spark, sf_dir):
    line = F.concat_ws("\t", F.col("n_nationkey").cast("string"), F.lit("x"), "n_name")
    return readers.column_file(spark, _written(spark, views.table(spark, sf_dir, "nation").select(line.alias("value")), "columns"), [2, 0])


@sql("SELECT n_name AS value FROM nation UNION ALL SELECT r_name FROM region")
def concatenated_files(spark, sf_dir):
    paths = [_written(spark, views.table(spark, sf_dir, t).select(F.col(f"{t[0]}_name").alias("value")), t) for t in ("nation", "region")]
    return readers.concatenated(spark, paths)


@sql(f"""WITH {ALN}, b AS (SELECT contig, strand, unnest(range(start0, end0 + 1)) AS p FROM aln WHERE mm = 3), d AS (SELECT contig, strand, p, count(*) AS n FROM b GROUP BY ALL HAVING count(*) >= 2)
SELECT CASE WHEN strand = '-' THEN 'minus_' ELSE 'plus_' END || contig AS track, p + 1 || ' ' || n AS value FROM d UNION ALL SELECT DISTINCT CASE WHEN strand = '-' THEN 'minus_' ELSE 'plus_' END || contig, 'variableStep chrom=' || contig FROM d""")
def wig_written(spark, sf_dir):
    from ..operators import coverage

    runs = coverage.coverage(views.alignments(spark, sf_dir).where("mm = 3"), ["contig", "strand"], block=1 << 12)
    path = _path(spark, "wig")
    writers.write_wig(runs, path, 2)
    return spark.read.text(path).select("track", "value")


@sql(f"""WITH {ALN} SELECT contig AS contig_id, 'strandweave' AS source, 'read' AS ftype, start0 + 1 AS start1, end0 + 1 AS end1, CAST(score AS VARCHAR) AS score, strand, CAST(NULL AS VARCHAR) AS phase, 'bd=' || read_id || ';mm=' || mm AS attributes FROM aln""")
def hit_feature_scan(spark, sf_dir):
    return readers.features(spark, _written(spark, writers.feature_lines(writers.hit_features(views.alignments(spark, sf_dir))), "hitgff"))


@sql(f"WITH {FEAT} SELECT f.feature_id, CAST(coalesce(n, 0) AS VARCHAR) AS phase FROM feat f LEFT JOIN (SELECT l_partkey AS feature_id, count(*) AS n FROM lineitem WHERE l_suppkey % 4 = 3 GROUP BY 1) c USING (feature_id)")
def counted_features(spark, sf_dir):
    counts = views.table(spark, sf_dir, "lineitem").where("l_suppkey % 4 = 3").groupBy(F.col("l_partkey").alias("feature_id")).agg(F.count(F.lit(1)).alias("n_reads"))
    return writers.count_features(views.features(spark, sf_dir).withColumn("phase", F.lit(".")), counts).select("feature_id", "phase")


@sql(f"WITH {ALN}, {SEQS}, spans AS (SELECT read_id, hit_no, substr(seq, start0 + 1, aln_len) AS seq FROM aln JOIN seqs ON doc_id = read_id % 97) SELECT read_id, hit_no, seq FROM spans WHERE seq <> ''")
def stored_spans(spark, sf_dir):
    """Spans from a reference store of small chunks, several of which a span may touch."""
    path = _path(spark, "reference")
    store.write_reference(_doc_contigs(spark, sf_dir), path, 32)
    spans = views.alignments(spark, sf_dir).select("read_id", "hit_no", (F.col("read_id") % 97).cast("string").alias("contig"), "start0", F.col("aln_len").alias("length"))
    return store.read_spans(spans, path, 32).where("seq <> ''").select("read_id", "hit_no", "seq")


@sql(f"WITH {ALN} SELECT read_id, hit_no, start0, strand FROM aln WHERE contig = 'N' AND start0 >= 50")
def stored_hits(spark, sf_dir):
    path = _path(spark, "hits")
    store.write_hits(views.alignments(spark, sf_dir), path)
    return store.hits_from(spark, path, "N", 50).select("read_id", "hit_no", "start0", "strand")


# -- rescue, consensus, edits, reports -----------------------------------------

#: A mate in every chunk of 256 colours of every document: as it is, with a wrong colour, with two bases lost, with two gained.
_MATES = f"""{LETTERS}, chunks AS (SELECT doc_id, colors, unnest(range(0, len(colors) // 256 + 1)) AS no FROM colored),
part AS (SELECT doc_id || ':' || no AS bead_id, CAST(doc_id AS VARCHAR) AS contig, 256 * no AS pos, (doc_id + no) % 4 AS kind, colors[256 * no + 61 + no % 15 : 256 * no + 82 + no % 15] AS p, colors[256 * no + 51 : 256 * no + 103] AS cl
  FROM chunks WHERE 256 * no + 82 + no % 15 <= len(colors)),
mate AS (SELECT *, rpad(array_to_string(cl, ''), 53, 'x') AS near, array_to_string(ml, '') AS mate FROM (SELECT bead_id, contig, pos, cl,
  CASE kind WHEN 0 THEN p[1:20] WHEN 1 THEN p[1:8] || [(p[9] + 1) % 4] || p[10:20] WHEN 2 THEN p[1:10] || [xor(xor(p[11], p[12]), p[13])] || p[14:22] ELSE p[1:9] || [0, 1, xor(1, p[10])] || p[11:18] END AS ml FROM part)),
place AS (SELECT *, unnest(range(0, 31)) AS r FROM mate)"""
_PREFIX = "list_prepend(CAST(0 AS BIGINT), list_transform(range(1, len({0}) + 1), lambda i: list_reduce({0}[1:i], lambda a, b: xor(a, b))))"


def _mates(spark, sf_dir):
    chunks = cut(mapping.chunk_reference(_doc_contigs(spark, sf_dir), 256, 33).select("contig", "chunk_start", color.encode_colors(F.col("seq")).alias("colors")))
    no = (F.col("chunk_start") / 256).cast(L)
    at, digit = 60 + no % 15, lambda i: F.substring("p", i, 1).cast("int")
    rows = chunks.where(F.length("colors") >= at + 22).select(F.concat_ws(":", "contig", no.cast("string")).alias("bead_id"), "contig", F.col("chunk_start").alias("pos"), F.substring(F.col("colors"), (at + 1).cast("int"), F.lit(22)).alias("p"), ((F.col("contig").cast(L) + no) % 4).alias("kind"))
    some = lambda a, n: F.substring("p", a, n)
    wrong = F.concat(some(1, 8), ((digit(9) + 1) % 4).cast("string"), some(10, 11))
    lost = F.concat(some(1, 10), digit(11).bitwiseXOR(digit(12)).bitwiseXOR(digit(13)).cast("string"), some(14, 9))
    gained = F.concat(some(1, 9), F.lit("01"), digit(10).bitwiseXOR(F.lit(1)).cast("string"), some(11, 8))
    mates = rows.select("bead_id", F.when(F.col("kind") == 0, some(1, 20)).when(F.col("kind") == 1, wrong).when(F.col("kind") == 2, lost).otherwise(gained).alias("colors"))
    return rows.select("bead_id", "contig", "pos"), mates, chunks


@sql(f"""WITH {_MATES} SELECT bead_id, contig, pos + 50 + r AS pos, CAST(mm AS INTEGER) AS mm FROM (SELECT *, hamming(substr(near, r + 1, 20), mate) AS mm FROM place WHERE r + 20 <= len(cl))
WHERE mm <= 1 QUALIFY rank() OVER (PARTITION BY bead_id ORDER BY mm) = 1""")
def rescued_mates(spark, sf_dir):
    return pairs.rescue(*_mates(spark, sf_dir), 256, 50, 80, 1)


@sql(f"""WITH {_MATES}, sums AS (SELECT p.*, px, mx FROM place p JOIN (SELECT bead_id, {_PREFIX.format("cl")} AS px, {_PREFIX.format("ml")} AS mx FROM (SELECT bead_id, cl, string_split(mate, '')::BIGINT[] AS ml FROM mate)) USING (bead_id) WHERE r + 20 <= len(cl)),
tries AS (SELECT *, d, c FROM sums, (VALUES (1), (2)) t(d), (SELECT unnest(range(1, 20)) AS c)),
split AS (SELECT bead_id, contig, pos, r, d AS size, c, hamming(substr(near, r + 1, c) || substr(near, r + d + c + 2, 19 - c), substr(mate, 1, c) || substr(mate, c + 2, 19 - c)) AS mm FROM tries WHERE xor(px[r + c + d + 2], px[r + c + 1]) = CAST(substr(mate, c + 1, 1) AS BIGINT)
  UNION ALL SELECT bead_id, contig, pos, r, -d, c, hamming(substr(near, r + 1, c) || substr(near, r + c + 2, 19 - c - d), substr(mate, 1, c) || substr(mate, c + d + 2, 19 - c - d)) FROM tries WHERE c < 20 - d AND cl[r + c + 1] = xor(mx[c + d + 2], mx[c + 1])),
best AS (SELECT * FROM split WHERE mm <= 1 QUALIFY row_number() OVER (PARTITION BY bead_id, r ORDER BY mm, abs(size), size DESC, c) = 1)
SELECT bead_id, contig, pos + 50 + r AS pos, CAST(size AS INTEGER) AS size, CAST(c AS INTEGER) AS cut, CAST(mm AS INTEGER) AS mm FROM best QUALIFY rank() OVER (PARTITION BY bead_id ORDER BY mm) = 1""")
def rescued_indels(spark, sf_dir):
    return pairs.rescue_indel(*_mates(spark, sf_dir), 256, 50, 80, 2, 1)


@sql(f"""WITH {SEQS}, c AS (SELECT CAST(doc_id AS VARCHAR) AS contig, seq, unnest(range(0, length(seq), 4096)) AS chunk_start FROM seqs WHERE seq <> '')
SELECT contig, chunk_start, sha256(CASE WHEN length(seq) = 1 THEN 'N' ELSE substr(seq, chunk_start + 1, 4096) END) AS seq_sha256 FROM c""")
def consensus_sequences(spark, sf_dir):
    """Every document from colour reads over the whole of it, a third of which have a wrong colour that others outvote."""
    texts = _doc_contigs(spark, sf_dir).where("seq <> ''").select("contig", F.length("seq").alias("length"), F.left("seq", F.lit(1)).alias("first"), color.encode_colors(F.col("seq")).alias("all"))
    # colours are encoded once a document; a read of 145 letters has 144
    rows = texts.select("contig", "length", "first", F.posexplode_outer(mapping.pieces(F.col("all"), 48, 96)).alias("no", "part"))
    rows = rows.select("contig", "length", "first", "no", F.coalesce(F.col("no").cast(L) * 48, F.lit(0).cast(L)).alias("pos"), F.coalesce("part", F.lit("")).alias("colors"))
    # the 49th colour is wrong where the two reads in front and the one behind hold it, too
    spoilt = F.concat(F.left("colors", F.lit(48)), F.translate(F.substring("colors", 49, 1), "0123", "1230"), F.substring("colors", 50, 1 << 20))
    rows = rows.withColumn("colors", F.when((F.col("no") % 3 == 2) & (F.length("colors") > 49), spoilt).otherwise(F.col("colors")))
    return assembly.consensus_contigs(rows).select("contig", "chunk_start", F.sha2("seq", 256).alias("seq_sha256"))


def _edits(spark, sf_dir):
    """A replacement, an insertion or a deletion every 500 letters of every document."""
    n = F.length("seq")
    rows = _doc_contigs(spark, sf_dir).where(n >= 103).select("contig", F.explode(F.sequence(F.lit(0), F.floor((n - 103) / 500).cast("int"))).alias("i"))
    pick = lambda *x: F.element_at(F.array(*map(F.lit, x)), F.col("i") % 3 + 1)
    return rows.select("contig", (F.col("i").cast(L) * 500 + 100).alias("place"), pick("R", "I", "D").alias("kind"), pick("TT", "GGA", "ACG").alias("text"))


_EDITS = f"{SEQS}, ed AS (SELECT doc_id, seq, i, 500 * i + 100 AS place FROM (SELECT doc_id, seq, unnest(range(0, (length(seq) - 103) // 500 + 1)) AS i FROM seqs WHERE length(seq) >= 103))"


@sql(f"""WITH {_EDITS}, seg AS (SELECT doc_id, i, CASE i % 3 WHEN 0 THEN 'TT' WHEN 1 THEN 'GGA' ELSE '' END || substr(seq, place + used + 1, coalesce(lead(place) OVER (PARTITION BY doc_id ORDER BY i), length(seq)) - place - used) AS part FROM (SELECT *, CASE i % 3 WHEN 0 THEN 2 WHEN 1 THEN 0 ELSE 3 END AS used FROM ed)),
done AS (SELECT doc_id, string_agg(part, '' ORDER BY i) AS tail FROM seg GROUP BY doc_id) SELECT CAST(doc_id AS VARCHAR) AS contig, sha256(CASE WHEN tail IS NULL THEN seq ELSE substr(seq, 1, 100) || tail END) AS seq_sha256 FROM seqs LEFT JOIN done USING (doc_id)""")
def edited_sequences(spark, sf_dir):
    return assembly.edit_contigs(_doc_contigs(spark, sf_dir), _edits(spark, sf_dir)).select("contig", F.sha2("seq", 256).alias("seq_sha256"))


@sql(f"WITH {_EDITS} SELECT CAST(doc_id AS VARCHAR) AS contig, place, place + CASE WHEN i % 3 = 2 THEN 3 ELSE 0 END - 5 AS start0, place + CASE WHEN i % 3 = 2 THEN 3 ELSE 0 END + 5 AS end0 FROM ed")
def edited_windows(spark, sf_dir):
    return assembly.edit_windows(_edits(spark, sf_dir)).select("contig", "place", "start0", "end0")


@sql(f"WITH {FEAT} SELECT contig, pos1, count(*) AS n, min(feature_id) AS first_feature FROM (SELECT contig, feature_id, unnest(range(start1, end1 + 1)) AS pos1 FROM feat) GROUP BY contig, pos1")
def feature_position_map(spark, sf_dir):
    f = merging.feature_positions(views.features(spark, sf_dir))
    return f.groupBy("contig", "pos1").agg(F.count(F.lit(1)).alias("n"), F.min("feature_id").alias("first_feature"))


@sql(f"WITH {ALN} SELECT o_orderkey AS read_id FROM orders WHERE o_orderkey NOT IN (SELECT read_id FROM aln WHERE mm = 3)")
def unmapped_reads(spark, sf_dir):
    reads = views.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("read_id"))
    return readers.unmapped(reads, views.alignments(spark, sf_dir).where("mm = 3"))


@sql(f"SELECT * FROM ({BASE_SQL['ptr_summary']}) WHERE n_ptr * 1000000 <= 485 * bases")
def dense_regions(spark, sf_dir):
    from .queries import ptr_summary

    return ntr.dense_enough(ptr_summary(spark, sf_dir), F.col("bases"), 485)


@sql(f"SELECT \"window\", measure, min_coverage AS x, y FROM (UNPIVOT (SELECT \"window\", min_coverage, CAST(n_ptr AS DOUBLE) AS n_ptr, CAST(bases AS DOUBLE) AS bases, CAST(n_ptr_matched AS DOUBLE) AS n_ptr_matched, CAST(n_atr_matched AS DOUBLE) AS n_atr_matched, mean_ptr_overlap, mean_atr_overlap FROM ({BASE_SQL['ptr_summary']})) ON n_ptr, bases, n_ptr_matched, n_atr_matched, mean_ptr_overlap, mean_atr_overlap INTO NAME measure VALUE y)")
def ptr_curves(spark, sf_dir):
    from .queries import ptr_summary

    return ntr.curves(ptr_summary(spark, sf_dir)).where("y IS NOT NULL")


@sql(f"SELECT CAST(row_number() OVER (ORDER BY contig, split_no, mm) AS BIGINT) AS place, concat_ws(chr(9), contig, split_no, mm, n_reads, n_all_splits) AS value FROM ({BASE_SQL['mismatch_report']}) UNION ALL SELECT 0, concat_ws(chr(9), 'sequence', 'split', 'mismatches', 'reads', 'all splits')")
def filter_report_text(spark, sf_dir):
    from .queries import mismatch_report

    titles = {"contig": "sequence", "split_no": "split", "mm": "mismatches", "n_reads": "reads", "n_all_splits": "all splits"}
    return writers.table_lines(mismatch_report(spark, sf_dir).select(*titles), ["contig", "split_no", "mm"], titles)


@sql(f"WITH {FEAT} SELECT contig AS contig_id, start1, end1, f_strand AS strand, 'ID=' || concat_ws('_', contig, f_strand, row_number() OVER (PARTITION BY contig, f_strand ORDER BY start1, end1)) || ';coverage=' || feature_id AS attributes FROM feat")
def region_gff(spark, sf_dir):
    regions = views.features(spark, sf_dir).select("contig", F.col("f_strand").alias("strand"), (F.col("start1") - 1).alias("start0"), (F.col("end1") - 1).alias("end0"), F.col("feature_id").alias("coverage"))
    return writers.region_features(regions).select("contig_id", "start1", "end1", "strand", "attributes")


@sql("SELECT CAST(n_nationkey + 1 AS INTEGER) AS pattern_id, bin(n_nationkey + 1) AS mask FROM nation")
def seed_mask_scan(spark, sf_dir):
    lines = views.table(spark, sf_dir, "nation").select(F.bin(F.col("n_nationkey") + 1).alias("value"))
    return readers.seed_masks(spark, _written(spark, lines, "masks"))


@sql("SELECT CAST(n_nationkey + 1 AS INTEGER) AS position, CAST(k // 4 AS INTEGER) AS ref_color, CAST(k % 4 AS INTEGER) AS read_color, CAST(n_nationkey * k % 7 AS INTEGER) AS cost FROM nation, (SELECT unnest(range(0, 16)) AS k)")
def score_matrix_scan(spark, sf_dir):
    costs = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda k: (F.col("n_nationkey") * k % 7).cast("string"))
    return readers.score_matrix(spark, _written(spark, views.table(spark, sf_dir, "nation").select(F.array_join(costs, " ").alias("value")), "costs"))
