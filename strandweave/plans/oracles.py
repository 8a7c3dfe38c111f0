"""DuckDB SQL for the queries of this package."""

from __future__ import annotations

from .queries import COVERAGES, FLANK, GAP, MAX_LOCI, MIN_POSSIBLE, MIN_SCORE, WINDOWS
from .views import ALPHABET, ONTO

ALN = """aln AS (SELECT l_orderkey AS read_id, l_linenumber AS hit_no, l_returnflag AS contig, CASE WHEN l_suppkey % 2 = 0 THEN '+' ELSE '-' END AS strand, l_partkey AS start0,
  l_partkey + CAST(l_quantity AS BIGINT) - 1 AS end0, CAST(l_quantity AS BIGINT) AS aln_len, CAST(l_quantity AS BIGINT) - 2 * (l_suppkey % 4) AS score, l_suppkey % 4 AS mm FROM lineitem)"""
FEAT = """feat AS (SELECT p_partkey AS feature_id, CASE p_size % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END AS contig, CASE p_partkey % 3 WHEN 0 THEN '+' WHEN 1 THEN '-' ELSE '.' END AS f_strand,
  p_partkey AS start1, p_partkey + 5 * p_size AS end1, p_brand AS gene, p_type AS transcript FROM part)"""
UNIQ = f"""{ALN}, ranked AS (SELECT *, row_number() OVER w AS rk, lead(score) OVER w AS second_score, count(*) OVER (PARTITION BY read_id) AS n_hits FROM aln
  WINDOW w AS (PARTITION BY read_id ORDER BY score DESC, contig, start0, strand, hit_no, aln_len)),
uniq AS (SELECT read_id, contig, strand, start0, end0, aln_len, score, mm, n_hits, second_score FROM ranked WHERE rk = 1 AND score - coalesce(second_score, {MIN_POSSIBLE - 1}) >= {GAP})"""
PAIRS = f"""{UNIQ}, {FEAT}, pairs AS (SELECT u.*, f.feature_id, f.start1 - 1 AS fs0, f.end1 - 1 AS fe0, least(u.end0, f.end1 - 1) - greatest(u.start0, f.start1 - 1) + 1 AS shared
  FROM uniq u JOIN feat f ON u.contig = f.contig AND (f.f_strand = u.strand OR f.f_strand = '.') AND u.start0 <= f.end1 - 1 AND f.start1 - 1 <= u.end0)"""


def sweep(table: str, weight: str = "1", name: str = "cov") -> str:
    """Run-length coverage of a table of intervals."""
    return f"""{name}_ev AS (SELECT contig, strand, start0 AS pt, {weight} AS d FROM {table} UNION ALL SELECT contig, strand, end0 + 1, -({weight}) FROM {table}),
{name}_net AS (SELECT contig, strand, pt, sum(d) AS d FROM {name}_ev GROUP BY ALL HAVING sum(d) <> 0),
{name} AS (SELECT * FROM (SELECT contig, strand, pt AS start0, lead(pt) OVER (PARTITION BY contig, strand ORDER BY pt) AS end0_excl, CAST(sum(d) OVER (PARTITION BY contig, strand ORDER BY pt) AS BIGINT) AS depth FROM {name}_net) WHERE depth > 0)"""


def islands(source: str, keys: str, s: str, e: str, gap: int, name: str) -> str:
    """Clusters of intervals at most ``gap`` beyond reach."""
    return f"""{name}_r AS (SELECT {keys}, {s} AS s, {e} AS e, max({e}) OVER (PARTITION BY {keys} ORDER BY {s}, {e} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {source}),
{name}_n AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach + {gap} THEN 1 ELSE 0 END) OVER (PARTITION BY {keys} ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS no FROM {name}_r),
{name} AS (SELECT {keys}, min(s) AS s, max(e) AS e, count(*) AS n FROM {name}_n GROUP BY {keys}, no)"""


COV = f"{UNIQ}, {sweep('uniq')}"
# every base of every run, and dense window sums: the plain form of what the engine solves piecewise
DENSE = f"""{COV}, params AS (SELECT w AS win, c AS min_coverage FROM (VALUES {', '.join(f'({w})' for w in WINDOWS)}) a(w), (VALUES {', '.join(f'({c})' for c in COVERAGES)}) b(c)),
bases AS (SELECT contig, strand, unnest(range(start0, end0_excl)) AS p, depth FROM cov),
spots AS (SELECT DISTINCT contig, strand, win, p + o AS p FROM bases, (SELECT win, unnest(range(win)) AS o FROM (SELECT DISTINCT win FROM params))),
sums AS (SELECT s.contig, s.strand, s.win, s.p, CAST(sum(coalesce(b.depth, 0)) OVER (PARTITION BY s.contig, s.strand, s.win ORDER BY s.p RANGE BETWEEN s.win - 1 PRECEDING AND CURRENT ROW) AS BIGINT) AS total
  FROM spots s LEFT JOIN bases b ON b.contig = s.contig AND b.strand = s.strand AND b.p = s.p),
hot AS (SELECT s.contig, s.strand, s.win, q.min_coverage, s.p FROM sums s JOIN params q ON q.win = s.win AND s.total >= q.min_coverage * s.win),
numbered AS (SELECT *, p - row_number() OVER (PARTITION BY contig, strand, win, min_coverage ORDER BY p) AS g FROM hot),
ptr AS (SELECT contig, strand, CAST(win AS BIGINT) AS win, CAST(min_coverage AS BIGINT) AS min_coverage, CAST(min(p) - win + 1 AS BIGINT) AS start0, CAST(max(p) AS BIGINT) AS end0 FROM numbered GROUP BY contig, strand, win, min_coverage, g)"""
ONE = "SELECT contig, strand, start0, end0 FROM ptr WHERE win = 20 AND min_coverage = 4"
EXON = f"""{FEAT}, exon AS (SELECT contig, CASE WHEN f_strand = '.' THEN '+' ELSE f_strand END AS strand, gene || '/' || substr(transcript, 1, 4) AS gene_id, transcript AS transcript_id, start1, start1 + feature_id % 7 AS end1 FROM feat)"""
_FLANKED = f"greatest(start1, end1 - {FLANK} + 1) AS left_start1, end1 AS left_end1, rs AS right_start1, least(re, rs + {FLANK} - 1) AS right_end1"
KNOWN = f"""{EXON}, kn AS (SELECT *, lead(start1) OVER w AS rs, lead(end1) OVER w AS re FROM exon WINDOW w AS (PARTITION BY contig, strand, gene_id, transcript_id ORDER BY start1, end1)),
known AS (SELECT contig, strand, gene_id, left_end1, right_start1, min(left_start1) AS left_start1, max(right_end1) AS right_end1, true AS is_known FROM (SELECT contig, strand, gene_id, {_FLANKED} FROM kn WHERE end1 < rs) GROUP BY ALL)"""
TAGS = f"""{ALN}, r AS (SELECT read_id AS bead_id, contig, strand, start0 AS pos, aln_len AS len, mm FROM aln WHERE hit_no % 2 = 1), f AS (SELECT read_id AS bead_id, contig, strand, start0 AS pos, aln_len AS len, mm FROM aln WHERE hit_no % 2 = 0)"""


def band(low: int, high: int, more: str = "") -> str:
    return f"""{TAGS}, band AS (SELECT r.bead_id, r.contig, r.strand, r.pos AS r_pos, f.pos AS f_pos, r.mm AS r_mm, f.mm AS f_mm, f.pos - r.pos + f.len AS distance FROM r JOIN f ON r.bead_id = f.bead_id AND r.contig = f.contig AND r.strand = f.strand
  WHERE f.pos - r.pos + f.len BETWEEN greatest({low}, r.len + f.len) AND {high}{more})"""


SEQ = f"translate(upper(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')), '{ALPHABET}', '{ONTO}')"
SEQS = f"seqs AS (SELECT doc_id, {SEQ} AS seq FROM documents)"
COLORS = "list_transform(range(1, length(seq)), lambda i: xor(instr('ACGT', letters[i]) - 1, instr('ACGT', letters[i + 1]) - 1))"
LETTERS = f"{SEQS}, parts AS (SELECT doc_id, seq, string_split(seq, '') AS letters FROM seqs), colored AS (SELECT doc_id, {COLORS} AS colors FROM parts)"
KMERS = f"{SEQS}, kmers AS (SELECT kmer, count(*) AS n FROM (SELECT substr(seq, CAST(i AS BIGINT), 8) AS kmer FROM (SELECT seq, unnest(range(1, length(seq) - 6)) AS i FROM seqs)) GROUP BY kmer)"
HIT = "read_id, hit_no, contig, strand, start0, score"


def contaminants(condition: str) -> str:
    return f"WITH {ALN}, t AS (SELECT read_id, max(CASE WHEN mm = 3 THEN 1 ELSE 0 END) AS a, min(CASE WHEN mm = 3 THEN 1 ELSE 0 END) AS b FROM aln GROUP BY read_id) SELECT read_id FROM t WHERE {condition}"


def prepair(select: str) -> str:
    return f"WITH {ALN}, l AS (SELECT o_orderkey AS bead_id, o_orderpriority AS r_tag FROM orders WHERE o_orderstatus <> 'P'), q AS (SELECT read_id AS bead_id, start0 AS f_pos FROM aln WHERE mm = 0) {select}"


def nearest(side: str) -> str:
    point, mark, rule, fold = ("start0", "end1 - 1", "<", "max") if side == "left" else ("end0", "start1 - 1", ">", "min")
    gap = "point - flank" if side == "left" else "flank - point"
    return f"""WITH {UNIQ}, {FEAT}, marks AS (SELECT contig, {mark} AS pt, feature_id FROM feat), points AS (SELECT read_id, contig, {point} AS point FROM uniq),
spots AS (SELECT DISTINCT contig, pt FROM marks), best AS (SELECT p.read_id, p.contig, p.point, (SELECT {fold}(pt) FROM spots s WHERE s.contig = p.contig AND s.pt {rule} p.point) AS flank FROM points p)
SELECT b.read_id, m.feature_id, CASE WHEN flank IS NOT NULL THEN {gap} END AS distance FROM best b LEFT JOIN marks m ON m.contig = b.contig AND m.pt = b.flank"""


ORACLES = {
    "unique_best_hit": f"WITH {UNIQ} SELECT * FROM uniq",
    "multiplicity_filter": f"WITH {ALN} SELECT read_id, hit_no, contig, start0, score, n_hits FROM (SELECT *, count(*) OVER (PARTITION BY read_id) AS n_hits FROM aln) WHERE n_hits BETWEEN 1 AND {MAX_LOCI} AND score >= {MIN_SCORE}",
    "top_score_hits": f"WITH {ALN} SELECT {HIT} FROM (SELECT *, rank() OVER (PARTITION BY read_id ORDER BY score DESC) AS rk FROM aln) WHERE rk = 1 AND score >= {MIN_SCORE}",
    "all_hits": f"WITH {ALN} SELECT {HIT} FROM aln WHERE score >= {MIN_SCORE}",
    "single_hits": f"WITH {ALN} SELECT {HIT} FROM (SELECT *, count(*) OVER (PARTITION BY read_id) AS n FROM aln) WHERE n = 1 AND score >= {MIN_SCORE}",
    "first_hits": f"WITH {ALN} SELECT read_id, contig, start0, strand, mm FROM (SELECT *, row_number() OVER (PARTITION BY read_id ORDER BY mm, contig, start0, strand, hit_no, aln_len) AS rk FROM aln) WHERE rk <= 2",
    "score_drop_hits": f"WITH {ALN} SELECT read_id, hit_no, start0, score FROM (SELECT *, max(score) OVER (PARTITION BY read_id) AS best FROM aln) WHERE score >= best - 5",
    "alignment_report": f"""WITH {ALN}, per AS (SELECT read_id, count(*) AS n, max(score) AS best, list_sort(list(score), 'DESC') AS s FROM aln GROUP BY read_id)
SELECT count(*) AS n_reads, count(*) FILTER (n < 1) AS n_too_few, count(*) FILTER (n > {MAX_LOCI}) AS n_too_many, count(*) FILTER (n BETWEEN 1 AND {MAX_LOCI}) AS n_in_range,
  count(*) FILTER (n BETWEEN 1 AND {MAX_LOCI} AND best >= {MIN_SCORE}) AS n_scoring, count(*) FILTER (n BETWEEN 1 AND {MAX_LOCI} AND best - coalesce(s[2], {MIN_POSSIBLE - 1}) >= {GAP}) AS n_unique FROM per""",
    "score_histogram": f"WITH {ALN} SELECT CAST(ceil(score / 5.0) AS BIGINT) * 5 AS bin, count(*) AS freq FROM aln GROUP BY bin",
    "score_histogram_cumulative": f"WITH {ALN}, h AS (SELECT CAST(ceil(score / 5.0) AS BIGINT) * 5 AS bin, count(*) AS freq FROM aln GROUP BY bin) SELECT bin, CAST(sum(freq) OVER (ORDER BY bin) AS BIGINT) AS freq FROM h",
    "mismatch_report": f"""WITH {ALN}, tags AS (SELECT read_id, contig, hit_no % 2 AS split_no, mm FROM aln), one AS (SELECT read_id, contig, split_no, min(mm) AS mm FROM tags GROUP BY ALL),
agreed AS (SELECT contig, count(*) AS n FROM (SELECT read_id, contig, count(DISTINCT split_no) AS k FROM tags GROUP BY ALL) WHERE k = (SELECT count(DISTINCT split_no) FROM tags) GROUP BY contig)
SELECT o.contig, o.split_no, o.mm, count(*) AS n_reads, coalesce(any_value(a.n), 0) AS n_all_splits FROM one o LEFT JOIN agreed a ON a.contig = o.contig GROUP BY o.contig, o.split_no, o.mm""",
    "contaminant_filter_off": contaminants("true"),
    "contaminant_filter_one": contaminants("a = 0"),
    "contaminant_filter_both": contaminants("b = 0"),
    "unaligned_reads": f"WITH {ALN} SELECT o_orderkey AS read_id FROM orders WHERE o_orderkey NOT IN (SELECT read_id FROM aln WHERE score >= 40)",
    "feature_counts": f"""WITH {UNIQ}, {FEAT}, hit AS (SELECT f.feature_id, count(*) AS n FROM uniq u JOIN feat f ON u.contig = f.contig AND (f.f_strand = u.strand OR f.f_strand = '.') AND u.start0 >= f.start1 - 4 AND u.end0 <= f.end1 + 2 GROUP BY f.feature_id)
SELECT f.feature_id, coalesce(h.n, 0) AS n_reads FROM feat f LEFT JOIN hit h ON h.feature_id = f.feature_id""",
    "feature_overlap_fraction": f"WITH {PAIRS} SELECT feature_id, count(*) AS n_overlaps, max(shared) AS max_shared, CAST(sum(shared) AS BIGINT) AS sum_shared, round(max(shared / CAST(fe0 - fs0 + 1 AS DOUBLE)), 6) AS max_fraction FROM pairs GROUP BY feature_id",
    "feature_full_span": f"WITH {ALN}, {FEAT} SELECT f.feature_id, count(*) AS n_spanning FROM aln a JOIN feat f ON a.contig = f.contig AND (f.f_strand = a.strand OR f.f_strand = '.') AND a.start0 <= f.start1 - 1 AND a.end0 >= f.end1 - 1 GROUP BY f.feature_id",
    "feature_distinct_starts": f"WITH {PAIRS} SELECT feature_id, count(*) AS n_hits, CAST(sum(shared) AS BIGINT) AS n_bases, count(DISTINCT start0) AS n_starts FROM pairs GROUP BY feature_id",
    "nearest_left": nearest("left"),
    "nearest_right": nearest("right"),
    "known_variant_band": f"""WITH {ALN}, known AS (SELECT DISTINCT CASE event_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END AS contig, user_id AS known_pos FROM events),
c AS (SELECT contig, start0 AS pos, read_id, hit_no FROM aln WHERE mm = 3)
SELECT contig, pos, read_id, hit_no, known_pos FROM (SELECT c.*, k.known_pos, row_number() OVER (PARTITION BY c.contig, c.pos, c.read_id, c.hit_no ORDER BY abs(c.pos - k.known_pos), k.known_pos) AS rk FROM c JOIN known k ON k.contig = c.contig AND abs(c.pos - k.known_pos) < 10) WHERE rk = 1""",
    "fusion_candidates": f"""WITH {ALN}, best AS (SELECT read_id, hit_no % 2 AS odd, min(contig) AS contig FROM (SELECT *, rank() OVER (PARTITION BY read_id, hit_no % 2 ORDER BY score DESC) AS rk FROM aln) WHERE rk = 1 GROUP BY ALL)
SELECT a.read_id, a.contig AS contig_a, b.contig AS contig_b FROM best a JOIN best b ON a.read_id = b.read_id AND a.odd = 1 AND b.odd = 0 WHERE a.contig <> b.contig""",
    "fusion_counts": f"""WITH {ALN}, a AS (SELECT read_id, min(contig) AS c FROM aln WHERE hit_no % 2 = 1 GROUP BY read_id), b AS (SELECT read_id, min(contig) AS c FROM aln WHERE hit_no % 2 = 0 GROUP BY read_id)
SELECT count(*) FILTER (b.c IS NULL) AS n_a_only, count(*) FILTER (a.c IS NULL) AS n_b_only, count(*) FILTER (a.c IS NOT NULL AND b.c IS NOT NULL) AS n_both, count(*) FILTER (a.c <> b.c) AS n_fusions FROM a FULL JOIN b ON a.read_id = b.read_id""",
    "coverage_rle": f"WITH {COV} SELECT contig, strand, start0, end0_excl, depth FROM cov",
    "coverage_threshold": f"WITH {COV}, high AS (SELECT contig, strand, start0, end0_excl - 1 AS last FROM cov WHERE depth >= 4), {islands('high', 'contig, strand', 'start0', 'last', 1, 'isl')} SELECT contig, strand, s AS start0, e + 1 AS end0_excl FROM isl",
    "weighted_coverage": f"""WITH {ALN}, share AS (SELECT *, CAST(pow(9, 3 - mm) AS BIGINT) * 1000 // CAST(sum(CAST(pow(9, 3 - mm) AS BIGINT)) OVER (PARTITION BY read_id) AS BIGINT) AS weight FROM aln),
wsome AS (SELECT * FROM share WHERE weight > 0), {sweep('wsome', 'weight')} SELECT contig, strand, start0, end0_excl, depth FROM cov""",
    "low_coverage_islands": f"""WITH {COV}, nx AS (SELECT *, lead(start0) OVER (PARTITION BY contig, strand ORDER BY start0) AS nxt FROM cov),
low AS (SELECT contig, strand, end0_excl AS start0, nxt - 1 AS last FROM nx WHERE nxt > end0_excl UNION ALL SELECT contig, strand, start0, end0_excl - 1 FROM cov WHERE depth <= 1), {islands('low', 'contig, strand', 'start0', 'last', 4, 'isl')}
SELECT contig, strand, s AS start0, e AS end0 FROM isl WHERE e - s + 1 <= 50""",
    "window_islands": f"WITH {DENSE} {ONE}",
    "ptr_sweep": f"WITH {DENSE} SELECT contig, strand, win AS \"window\", min_coverage, start0, end0 FROM ptr",
    "ptr_summary": f"""WITH {DENSE}, {FEAT}, ann AS (SELECT feature_id, contig, f_strand AS strand, start1 - 1 AS fs0, end1 - 1 AS fe0 FROM feat WHERE f_strand <> '.'),
m AS (SELECT p.*, a.feature_id, (least(end0, fe0) - greatest(start0, fs0) + 1) / CAST(end0 - start0 + 1 AS DOUBLE) AS po, (least(end0, fe0) - greatest(start0, fs0) + 1) / CAST(fe0 - fs0 + 1 AS DOUBLE) AS ao
  FROM ptr p JOIN ann a ON a.contig = p.contig AND a.strand = p.strand AND p.start0 <= a.fe0 AND a.fs0 <= p.end0),
k AS (SELECT * FROM m WHERE greatest(po, ao) * 100 >= 50),
bp AS (SELECT win, min_coverage, count(*) AS n, avg(o) AS o FROM (SELECT win, min_coverage, contig, strand, start0, end0, max(po) AS o FROM k GROUP BY ALL) GROUP BY ALL),
ba AS (SELECT win, min_coverage, count(*) AS n, avg(o) AS o FROM (SELECT win, min_coverage, feature_id, max(ao) AS o FROM k GROUP BY ALL) GROUP BY ALL),
ev AS (SELECT win, min_coverage, count(*) AS n_ptr, CAST(sum(end0 - start0 + 1) AS BIGINT) AS bases FROM ptr GROUP BY ALL)
SELECT ev.win AS "window", ev.min_coverage, n_ptr, bases, coalesce(bp.n, 0) AS n_ptr_matched, coalesce(ba.n, 0) AS n_atr_matched, round(bp.o, 6) AS mean_ptr_overlap, round(ba.o, 6) AS mean_atr_overlap
FROM ev LEFT JOIN bp ON bp.win = ev.win AND bp.min_coverage = ev.min_coverage LEFT JOIN ba ON ba.win = ev.win AND ba.min_coverage = ev.min_coverage""",
    "region_mean_depth": f"""WITH {DENSE}, one AS ({ONE}) SELECT o.contig, o.strand, o.start0, o.end0, CAST(coalesce(sum(b.depth), 0) AS BIGINT) AS area, round(coalesce(sum(b.depth), 0) / CAST(o.end0 - o.start0 + 1 AS DOUBLE), 6) AS mean_depth
FROM one o LEFT JOIN bases b ON b.contig = o.contig AND b.strand = o.strand AND b.p BETWEEN o.start0 AND o.end0 GROUP BY o.contig, o.strand, o.start0, o.end0""",
    "trim_regions": f"""WITH {DENSE}, one AS ({ONE}), inside AS (SELECT o.*, b.p, b.depth, sum(b.depth) OVER (PARTITION BY o.contig, o.strand, o.start0, o.end0) AS area FROM one o JOIN bases b ON b.contig = o.contig AND b.strand = o.strand AND b.p BETWEEN o.start0 AND o.end0)
SELECT contig, strand, start0, end0, CAST(area AS BIGINT) AS area, min(p) AS trimmed_start0, max(p) AS trimmed_end0 FROM inside WHERE depth * 100 * (end0 - start0 + 1) >= area * 80 GROUP BY contig, strand, start0, end0, area""",
    "cluster_intervals": f"WITH {FEAT}, iv AS (SELECT contig, f_strand, start1 AS a, start1 + end1 % 7 AS b FROM feat), {islands('iv', 'contig, f_strand', 'a', 'b', 0, 'isl')} SELECT contig, f_strand, s AS \"start\", e AS \"end\", n FROM isl",
    "known_junctions": f"WITH {KNOWN} SELECT * FROM known",
    "putative_junctions": f"""WITH {KNOWN}, ex AS (SELECT DISTINCT contig, strand, gene_id, start1, end1 FROM exon), p AS (SELECT a.contig, a.strand, a.gene_id, a.start1, a.end1, b.start1 AS rs, b.end1 AS re FROM ex a JOIN ex b ON a.contig = b.contig AND a.strand = b.strand AND a.gene_id = b.gene_id AND a.end1 < b.start1),
put AS (SELECT contig, strand, gene_id, left_end1, right_start1, min(left_start1) AS left_start1, max(right_end1) AS right_end1, false AS is_known FROM (SELECT contig, strand, gene_id, {_FLANKED} FROM p) GROUP BY ALL)
SELECT p.* FROM put p WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.contig = p.contig AND k.strand = p.strand AND k.gene_id = p.gene_id AND k.left_end1 = p.left_end1 AND k.right_start1 = p.right_start1)""",
    "gene_spans": f"WITH {EXON} SELECT gene_id, min(start1) AS start1, max(end1) AS end1, count(DISTINCT contig) AS n_contigs, count(DISTINCT strand) AS n_strands FROM exon GROUP BY gene_id",
    "dup_suffix": f"WITH {FEAT} SELECT feature_id, CASE WHEN n > 1 THEN transcript || '_dup' || n ELSE transcript END AS unique_name FROM (SELECT feature_id, transcript, row_number() OVER (PARTITION BY transcript ORDER BY feature_id) AS n FROM feat)",
    "dedup_features": f"WITH {FEAT} SELECT DISTINCT contig, f_strand, gene, transcript FROM feat",
    "pairs_in_band": f"WITH {band(40, 500, ' OR (f.pos - r.pos + f.len > 800 AND f.pos - r.pos + f.len <= 900)')} SELECT * FROM band",
    "unique_pairs": f"WITH {band(0, 2000)} SELECT bead_id, contig, distance FROM (SELECT *, count(*) OVER (PARTITION BY bead_id) AS n FROM band) WHERE n = 1",
    "pair_distance_hist": f"WITH {band(0, 2000)}, h AS (SELECT contig || strand AS class, CAST(floor(distance / 100.0) AS BIGINT) * 100 AS bin FROM band) SELECT class, bin, count(*) AS n_pairs FROM h GROUP BY class, bin UNION ALL SELECT class, NULL, count(*) FROM h GROUP BY class",
    "pair_classes": f"""WITH {TAGS}, k AS (SELECT r.bead_id, min(CASE WHEN r.contig = f.contig AND r.strand = f.strand AND f.pos - r.pos + f.len BETWEEN 40 AND 500 THEN 0 WHEN r.contig = f.contig AND r.strand = f.strand THEN 1 WHEN r.contig = f.contig THEN 2 ELSE 3 END) AS c FROM r JOIN f ON r.bead_id = f.bead_id GROUP BY r.bead_id)
SELECT bead_id, CASE c WHEN 0 THEN 'good' WHEN 1 THEN 'distance' WHEN 2 THEN 'strand' ELSE 'contig' END AS class FROM k
UNION ALL SELECT DISTINCT bead_id, 'r_only' FROM r WHERE bead_id NOT IN (SELECT bead_id FROM f) UNION ALL SELECT DISTINCT bead_id, 'f_only' FROM f WHERE bead_id NOT IN (SELECT bead_id FROM r)""",
    "min_mismatch_hits": f"WITH {ALN} SELECT read_id, hit_no, contig, start0, mm FROM (SELECT *, rank() OVER (PARTITION BY read_id, contig ORDER BY mm) AS rk FROM aln) WHERE rk = 1",
    "prepair_inner": prepair("SELECT l.bead_id, r_tag, f_pos FROM l JOIN q ON l.bead_id = q.bead_id"),
    "prepair_left_only": prepair("SELECT * FROM l WHERE bead_id NOT IN (SELECT bead_id FROM q)"),
    "prepair_right_only": prepair("SELECT * FROM q WHERE bead_id NOT IN (SELECT bead_id FROM l)"),
    "color_encode": f"WITH {LETTERS} SELECT doc_id, sha256(coalesce(array_to_string(colors, ''), '')) AS colors_sha256 FROM colored",
    "color_xor_sum": f"WITH {LETTERS} SELECT doc_id, CAST(CASE WHEN len(colors) = 0 THEN 0 ELSE list_reduce(colors, lambda a, b: xor(a, b)) END AS INTEGER) AS xor_sum FROM colored",
    "color_roundtrip": f"WITH {SEQS} SELECT doc_id, substr(seq, 1, 60) AS read, substr(seq, 1, 60) AS decoded FROM seqs WHERE length(seq) >= 2",
    "revcomp": f"WITH {SEQS} SELECT doc_id, sha256(reverse(translate(seq, 'ACGT', 'TGCA'))) AS revcomp_sha256 FROM seqs",
    "kmer_counts": f"WITH {KMERS} SELECT kmer, n FROM kmers",
    "repeat_class": f"WITH {KMERS} SELECT doc_id, coalesce(a.n, 0) > 100 OR coalesce(b.n, 0) > 100 AS is_repeat FROM seqs s LEFT JOIN kmers a ON a.kmer = substr(seq, 1, 8) LEFT JOIN kmers b ON b.kmer = right(seq, 8) WHERE length(seq) >= 8",
    "seed_map_documents": f"""WITH {SEQS}, probes AS (SELECT item_id, {SEQ} AS seq FROM benchmark), seeds AS (SELECT item_id, no, substr(seq, CAST(no * 24 + 1 AS BIGINT), 24) AS key FROM (SELECT item_id, seq, unnest(range(length(seq) // 24)) AS no FROM probes)),
places AS (SELECT doc_id, pt, substr(seq, CAST(pt + 1 AS BIGINT), 24) AS key FROM (SELECT doc_id, seq, unnest(range(length(seq) - 23)) AS pt FROM seqs WHERE length(seq) >= 24))
SELECT item_id, doc_id, pt - no * 24 AS diagonal, count(*) AS n_seeds FROM places JOIN seeds USING (key) GROUP BY ALL""",
    "mapability": f"""WITH {ALN} SELECT read_id, round(count(*) FILTER (mm = 0) + count(*) FILTER (mm = 1) / 75.0::DOUBLE + count(*) FILTER (mm = 2) / 2700.0::DOUBLE + count(*) FILTER (mm = 3) / 62100.0::DOUBLE - 1, 6) AS mapability FROM aln GROUP BY read_id""",
    "corr_compat": "SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 6) AS r, round(corr(l_quantity, l_extendedprice) * (count(*) - 1) / count(*), 6) AS r_compat FROM lineitem GROUP BY l_returnflag",
    "var_compat": "SELECT l_returnflag, round(avg(l_quantity), 6) AS mean, round(var_samp(l_quantity), 6) AS var, round(var_pop(l_quantity), 6) AS var_pop, median(l_quantity) AS median FROM lineitem GROUP BY l_returnflag",
    "panel_intersection": "SELECT user_id % 997 AS panel FROM events WHERE event_type = 'click' INTERSECT SELECT user_id % 997 FROM events WHERE event_type <> 'click'",
    "equal_groups": "SELECT s_suppkey, CAST(ntile(7) OVER (ORDER BY s_suppkey) AS INTEGER) AS panel_group FROM supplier",
    "natural_sort_rank": "SELECT s_name, CAST(row_number() OVER (ORDER BY coalesce(TRY_CAST(regexp_extract(s_name, '(\\d+)', 1) AS BIGINT), 2147483647), s_name) AS INTEGER) AS place FROM supplier",
}
