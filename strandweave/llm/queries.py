"""The registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audio, bpe, chat, decontaminate, lines, neardup, pii, quality, secret_scan, token_counts
from .common import read

CONTROL_TEXT = "\\### Assistant: </turn> ok"


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(1).select(F.lit(-7).cast("bigint").alias("conv_id"), F.explode(F.array(*[F.struct(F.lit(i).cast("bigint").alias("turn"), F.lit(r).alias("role"), F.lit(CONTROL_TEXT).alias("text")) for i, r in enumerate(("user", "assistant"))])).alias("x")).select("conv_id", "x.*")
    out = chat.read_chats(chat.format_chats(chat.messages(rows.unionByName(probe))))
    line = F.lit("\n")
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], line, t["text"], line)), "")
    loss = F.array_join("loss_texts", "")
    return out.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"), F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("bigint").alias("formatted_chars"))


OP1_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(15 + length(replace(replace(replace(role, '\', '\\'), '<', '\<'), chr(10), '\n')) + length(replace(replace(text, '\', '\\'), '<', '\<'))) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_classes(read(spark, sf_dir, "documents").select("doc_id", "text"))


OP2_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9\x{80}-\x{10FFFF}]+') AS ws FROM documents),
one AS (SELECT min(doc_id) AS d, ws, count(*) AS n FROM w WHERE len(ws) > 0 GROUP BY ws),
g AS (SELECT DISTINCT d, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i : i + 4], ' ') END AS gram FROM (SELECT d, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM one)),
size AS (SELECT d, count(*) AS n FROM g GROUP BY d),
pair AS (SELECT a.d AS a, b.d AS b, count(*) AS both_ FROM g a JOIN g b ON a.gram = b.gram AND a.d < b.d GROUP BY a.d, b.d),
link AS (SELECT a, b FROM pair JOIN size x ON x.d = a JOIN size y ON y.d = b WHERE both_ >= 0.8 * (x.n + y.n - both_) - 1e-9),
both_ways AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT d AS v, d AS r FROM one UNION SELECT b, r FROM reach JOIN both_ways ON a = v),
comp AS (SELECT v, min(r) AS class_id FROM reach GROUP BY v),
named AS (SELECT doc_id, class_id FROM w JOIN one USING (ws) JOIN comp ON v = d)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, CAST(coalesce(count(*) OVER (PARTITION BY class_id), 1) AS BIGINT) AS n_class FROM named
UNION ALL SELECT doc_id, doc_id, 1 FROM w WHERE len(ws) = 0
"""


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"))
    return token_counts.count_tokens(docs, tokenizer_file("piece_bpe_32k.model")).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    path = tokenizer_file("byte_bpe_50k.tiktoken")
    encoded = bpe.bpe_encode(docs, path, public_tokenizers.PATTERN).drop("text")
    return bpe.bpe_decode(encoded, path, public_tokenizers.PATTERN).select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"), audio.payload(F.col("text")).alias("payload"))
    out = audio.audio_features(audio.store_pcm(docs).drop("payload"), stored=True)
    feature = F.concat_ws(":", F.col("n_frames").cast("string"), F.col("n_tensors").cast("string"), F.size("segments").cast("string"), F.array_join(F.transform("mel_mean", lambda x: F.format_number(x, 2)), ","))
    return out.select(
        "doc_id", "n_bytes", F.octet_length("samples").cast("bigint").alias("payload_bytes"), F.sha2("samples", 256).alias("payload_sha256"), F.crc32(F.expr("substring(samples, -16, 16)")).alias("tail_crc32"),
        F.octet_length("media").cast("bigint").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), feature.alias("feature"), F.sha2("tensors", 256).alias("tensors_sha256"),
    )


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(read(spark, sf_dir, "documents").select("doc_id", "text", "source")).select("doc_id", "secrets")
    joined = F.array_join(F.transform("secrets", lambda x: F.concat_ws(":", x["rule"], x["s"].cast("string"), x["e"].cast("string"))), ",")
    return found.select("doc_id", F.size("secrets").cast("bigint").alias("n_secrets"), F.array_max(F.transform("secrets", lambda x: x["score"])).alias("top_score"), joined.alias("spans"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


#: White space as Python's texts split at it; RE2 knows the ASCII part only.
_SPACE = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_WORDS = "regexp_extract_all(lower({}), '[a-z0-9\\x{{80}}-\\x{{10FFFF}}]+')"
OP5_SQL = rf"""
WITH item AS (SELECT row_number() OVER () AS k, t, {_WORDS.format("t")} AS ws FROM (SELECT DISTINCT coalesce(text, '') AS t FROM benchmark)),
stat AS (SELECT count(*) AS n, avg(len(ws)) AS mean FROM item),
tf AS (SELECT k, w, count(*) AS tf FROM (SELECT k, unnest(ws) AS w FROM item) GROUP BY k, w),
df AS (SELECT w, count(*) AS df FROM tf GROUP BY w),
raw AS (SELECT k, w, ln(1 + (n - df + 0.5e0) / (df + 0.5e0)) * tf * 2.2e0 / (tf + 1.2e0 * (0.25e0 + 0.75e0 * len(ws) / greatest(1, mean))) AS v, least(1, 64e0 / greatest(1, len(ws))) AS reach FROM tf JOIN df USING (w) JOIN item USING (k), stat),
post AS (SELECT k, w, v / greatest(0.6e0 * sum(v) OVER (PARTITION BY k) * reach, 1e-9) AS v FROM raw),
doc AS (SELECT row_number() OVER () AS d, doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
step AS (SELECT d, unnest(ws) AS w, unnest(range(len(ws))) // 64 AS step FROM doc),
win AS (SELECT DISTINCT d, step + x AS win, w FROM step, (VALUES (0), (1)) t(x) WHERE w IN (SELECT w FROM post)),
hit AS (SELECT d, k, max(s) AS bm25 FROM (SELECT d, win, k, sum(v) AS s FROM win JOIN post USING (w) GROUP BY ALL) WHERE s >= 1 - 1e-9 GROUP BY d, k),
tok AS (SELECT k, t, regexp_extract_all(t, '[^{_SPACE}]+[{_SPACE}]*') AS ts FROM item),
cut AS (SELECT k, t, ts, list_max(list_filter(range(3, len(ts) - 2), lambda i: regexp_matches(ts[i], '([.?!…][{_SPACE}]+|\n)$'))) AS c FROM tok),
half AS (SELECT k, {_WORDS.format("CASE WHEN c IS NULL THEN t ELSE array_to_string(ts[1:c], '') END")} AS q, {_WORDS.format("CASE WHEN c IS NULL THEN '' ELSE array_to_string(ts[c + 1:], '') END")} AS a FROM cut),
part AS (SELECT k, len(q) AS c, list_concat(q, a) AS ws, least(5, len(q) + len(a)) AS n FROM half),
gram AS (SELECT DISTINCT k, n, i + n - 1 > c AS answer, array_to_string(ws[i : i + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS i FROM part)),
own AS (SELECT DISTINCT d, n, array_to_string(ws[i : i + n - 1], ' ') AS g FROM (SELECT d, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM (SELECT DISTINCT d, n FROM hit JOIN part USING (k)) JOIN doc USING (d))),
share AS (SELECT d, k, avg(CASE WHEN own.g IS NULL THEN 0 ELSE 1 END) FILTER (NOT answer) AS q, avg(CASE WHEN own.g IS NULL THEN 0 ELSE 1 END) FILTER (answer) AS a FROM hit JOIN gram USING (k) LEFT JOIN own USING (d, n, g) GROUP BY d, k)
SELECT doc_id, item_id, round_even(bm25, 6) AS bm25, round_even(coalesce(q, 1e0), 6) AS question_overlap, round_even(coalesce(a, 1e0), 6) AS answer_overlap
FROM hit JOIN share USING (d, k) JOIN doc USING (d) JOIN item USING (k) JOIN benchmark b ON coalesce(b.text, '') = t WHERE coalesce(q, 1) >= 0.5 AND coalesce(a, 1) >= 0.5
"""


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit_quality(docs, read(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model).select("doc_id", (~quality.may_learn(F.col("doc_id"))).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    joined = lambda rows: F.array_join(F.transform(rows, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")
    base = F.filter("pii", lambda x: x["base"])
    counts = [F.expr(f"CAST(size(filter(pii, x -> x.base AND x.kind = '{k}')) AS bigint)").alias(f"n_{k}") for k in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("pii")).alias("spans"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    joined = lines.join_lines(docs, least=1)
    out = lines.dedup_lines(docs, least=1, joined=joined).select("doc_id", "n_lines", "n_removed", "n_near", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
    return lines.with_links(out, joined)


OP10_SQL = r"""
WITH RECURSIVE line AS (SELECT doc_id, i, ls[i] AS t FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
sets AS (SELECT doc_id, i, t, list_sort(list_distinct(regexp_extract_all(lower(t), '[a-z0-9\x{80}-\x{10FFFF}]+'))) AS ws FROM line),
cls AS (SELECT row_number() OVER (ORDER BY min((doc_id, i))) AS c, ws, len(ws) AS n, min((doc_id, i)) AS first_, count(*) AS times FROM sets WHERE len(ws) > 0 GROUP BY ws),
word AS (SELECT c, n, unnest(ws) AS w FROM cls), freq AS (SELECT w, count(*) AS f FROM word GROUP BY w),
ranked AS (SELECT c, n, w, row_number() OVER (PARTITION BY c ORDER BY f, w) AS pos FROM word JOIN freq USING (w)),
prefix AS (SELECT c, n, w FROM ranked WHERE pos <= n - CAST(ceil(0.8 * n - 1e-9) AS BIGINT) + 1),
cand AS (SELECT DISTINCT a.c AS a, b.c AS b FROM prefix a JOIN prefix b ON a.w = b.w AND a.c < b.c AND least(a.n, b.n) >= 0.8 * greatest(a.n, b.n) - 1e-9),
link AS (SELECT a, b FROM (SELECT a, b, x.n AS n, y.n AS m, len(list_intersect(x.ws, y.ws)) AS both_ FROM cand JOIN cls x ON x.c = a JOIN cls y ON y.c = b) WHERE both_ >= 0.8 * (n + m - both_) - 1e-9),
both_ways AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
degree AS (SELECT a AS c, count(*) AS degree, min(y.first_) AS e FROM both_ways JOIN cls y ON y.c = b GROUP BY a),
placed AS (SELECT s.doc_id, s.i, s.t, k.c, k.times, coalesce(degree, 0) AS degree, (s.doc_id, s.i) > first_ AS later, coalesce(e < (s.doc_id, s.i), false) AS near FROM sets s LEFT JOIN cls k USING (ws) LEFT JOIN degree d ON d.c = k.c),
kept AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (c IS NOT NULL AND (later OR near)) AS n_removed, count(*) FILTER (c IS NOT NULL AND near AND NOT later) AS n_near,
  coalesce(string_agg(t, chr(10) ORDER BY i) FILTER (c IS NULL OR NOT (later OR near)), '') AS text FROM placed GROUP BY doc_id),
links AS (SELECT doc_id, CAST(sum(CASE WHEN times > 1 THEN k ELSE 0 END + degree) AS BIGINT) AS n_links FROM (SELECT doc_id, c, times, degree, count(*) AS k FROM placed WHERE c IS NOT NULL GROUP BY ALL) GROUP BY doc_id),
edge AS (SELECT DISTINCT 'd' || doc_id AS u, 'c' || c AS v FROM placed WHERE c IS NOT NULL AND (times > 1 OR degree > 0) UNION SELECT 'c' || a, 'c' || b FROM link),
ways AS (SELECT u, v FROM edge UNION SELECT v, u FROM edge),
reach AS (SELECT doc_id AS r, 'd' || doc_id AS v FROM (SELECT DISTINCT doc_id FROM documents) UNION SELECT r, ways.v FROM reach JOIN ways ON ways.u = reach.v),
comp AS (SELECT v, min(r) AS class_id FROM reach GROUP BY v)
SELECT doc_id, class_id, n_lines, n_removed, n_near, coalesce(n_links, 0) AS n_links, sha256(text) AS kept_sha256 FROM kept LEFT JOIN links USING (doc_id) JOIN comp ON v = 'd' || doc_id
"""


QUERIES = {f.__name__: f for f in (op1_chat_format, op2_near_dedup, op3_token_counts, op4_secret_scan, op5_decontaminate, op6_byte_bpe, op7_media_columns, op8_quality, op9_personal_data, op10_line_dedup)}
ORACLES = {"op1_chat_format": OP1_SQL, "op2_near_dedup": OP2_SQL, "op5_decontaminate": OP5_SQL, "op10_line_dedup": OP10_SQL}
