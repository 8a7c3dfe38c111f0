"""Column names, ids and shapes that operators must not trip over."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandweave.llm import audio, bpe, chat, decontaminate, lines, neardup, pii, quality, secret_scan, sketch, spans, token_counts
from strandweave.llm.groups import components
from strandweave.llm.queries import tokenizer_file
from strandweave.llm.trees import predict

NAMES = ["email", "phone", "card", "ip", "number", "address", "account", "mixed", "assigned", "named", "base_", "more_", "matches_", "found_", "path_", "hits_", "between_", "clean_text", "_base", "_count", "_digest", "_doc", "_key", "_class", "_lines", "_may", "doc_key", "row_key", "may_lose", "lost_lines", "near_", "doc_", "gone_", "times_", "class_", "place_", "digest_key", "count_key", "cls", "doc", "row"]
TEXT = "one two three four five six seven\ncall a@b.co now or pay 4111 1111 1111 1111"


def wide(spark):
    rows = [(i, t, "app.py") for i, t in enumerate([TEXT, TEXT, "other words are here for you now", None])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    return df.select("*", *[F.concat(F.lit(n + ":"), F.col("doc_id").cast("string")).alias(n) for n in NAMES])


OPERATORS = {
    "near": lambda df: neardup.drop_near_duplicates(df),
    "tokens": lambda df: token_counts.count_tokens(df, tokenizer_file("piece_bpe_32k.model")),
    "secrets": lambda df: secret_scan.find_secrets(df),
    "pii": lambda df: pii.find_personal_data(df),
    "lines": lambda df: lines.linked_lines(df, least=1),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_extra_columns_stay(spark, name):
    out = OPERATORS[name](wide(spark))
    got = out.collect()
    assert set(wide(spark).columns) <= set(out.columns) and len(got) == (3 if name == "near" else 4)
    assert all(r[n] == f"{n}:{r.doc_id}" for r in got for n in NAMES)


def test_text_ids(spark):
    rows = [("b", "q w e r t y u i\nnew"), ("a", "q w e r t y u i"), ("c", "k l m n o p s t"), (None, "k l m n o p s t"), ("c", "k l m n o p s t")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    got = {(r.doc_id, r.text, r.class_id) for r in lines.linked_lines(df, least=1).collect()}
    assert got == {("a", rows[1][1], "a"), ("b", "new", "a"), (None, rows[3][1], None), ("c", "", None)}
    same = spark.createDataFrame([("y", "q w e r t y u i"), ("x", "q w e r t y u i"), ("z", "k l m n o p s t")], "doc_id string, text string")
    assert {(r.doc_id, r.class_id, r.n_class) for r in neardup.near_classes(same).collect()} == {("x", "x", 2), ("y", "x", 2), ("z", "z", 1)}
    assert sorted(r.doc_id for r in neardup.drop_near_duplicates(same).collect()) == ["x", "z"]


def test_unknown_parts(spark):
    parts = [("video", "t", "r"), ("attachment", None, "a"), (None, "plain <", None), ("image", None, "i")]
    rows = [(1, [("user", [(k, t, r, 28, 28, 1.0, 2) for k, t, r in parts]), ("assistant", [("text", "ok", None, None, None, None, None)])])]
    out = chat.read_chats(chat.format_chats(spark.createDataFrame(rows, f"conv_id int, messages {chat.MESSAGES}"))).first()
    assert [t.text for t in out.turns] == ["<other:0><other:1>plain <<image:2>", "ok"] and out.loss_texts == ["ok"]
    assert [(a.kind, a.ref, a.tokens) for a in out.attachments] == [("video", "r", 0), ("attachment", "a", 0), ("image", "i", 4)]


def test_components_equal_union_find(spark):
    draw = random.Random(2)
    edges = [(draw.randrange(400), draw.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(300)] + [(5000, 5001 + i) for i in range(500)]
    top = list(range(6000))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in edges:
        top[max(root(a), root(b))] = min(root(a), root(b))
    want = {x: root(x) for e in edges if e[0] != e[1] for x in e}
    assert {r.node: r.comp for r in components(spark.createDataFrame(edges, "cls bigint, other bigint")).collect()} == want


def test_bloom_holds_all(spark):
    values = [x * 7919 - 3 for x in range(5000)]
    held = sketch.bloom(spark.createDataFrame([(v,) for v in values], "v bigint"), len(values))
    assert held.holds(np.array(values)).all() and held.holds(np.arange(10**6, 10**6 + 10000)).mean() < 0.1


def test_line_join_in_triangles(spark, monkeypatch):
    """Hot words and large groups that are dealt to cells give the same links."""
    from . import test_lines

    draw = random.Random(6)
    base = [[f"w{draw.randrange(80)}" for _ in range(14)] for _ in range(6)]
    rows = []
    for d in range(220):
        line = list(draw.choice(base))
        line[draw.randrange(14)] = f"own{draw.randrange(40)}"
        rows.append((d, " ".join(line) + "\nshared line of words"))
    monkeypatch.setattr(lines, "HOT", 8)
    monkeypatch.setattr(lines, "WIDE", 16)
    got, kept = test_lines.linked(spark, rows)
    assert got == test_lines.brute_links(rows) and kept == test_lines.brute_force(rows, least=1)


def test_first_doc_is_the_lowest(spark):
    draw = random.Random(9)
    base = [[f"w{draw.randrange(30)}" for _ in range(10)] for _ in range(12)]
    rows = [(d, "\n".join(" ".join(f"w{draw.randrange(30)}" if draw.random() < 0.06 else w for w in draw.choice(base)) for _ in range(3))) for d in range(120)]
    sets = [(d, i, frozenset(t.split())) for d, text in rows for i, t in enumerate(text.split("\n"))]
    want = {}
    for d, i, s in sets:
        for e, j, o in sets:
            if (e, j) < (d, i) and len(s & o) >= 0.8 * len(s | o) - 1e-9:
                want[d] = min(want.get(d, e), e)
                break
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"), least=1).collect()
    assert {r.doc_id: r.first_doc for r in got if r.first_doc is not None} == want and want


def test_shards_don_t_change_scores(spark):
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    text = items.first().text.split()
    part = spark.createDataFrame([(10**6 + i, " ".join(text[: len(text) - i])) for i in range(0, len(text) // 2, 3)], "doc_id bigint, text string")
    docs = docs.select("doc_id", "text").unionByName(part)
    items = items.unionByName(items.limit(2).withColumn("item_id", F.col("item_id") + 10**6))
    rows = [sorted(tuple(r) for r in decontaminate.matches(docs, items, shard_bytes=size).collect()) for size in (4 << 20, 2000)]
    assert rows[0] == rows[1] and len({r[0] for r in rows[0]} & {10**6, 10**6 + 3}) == 2


def test_many_matches_of_one_text(spark):
    texts = [" ".join(f"u{i}@host{i}.org 10.0.{i % 256}.7" for i in range(n)) for n in (1, 63, 64, 65, 1000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    out = spans.with_matches(df, F.col("text"), {"mail": (r"[a-z0-9]+@[a-z0-9.]+", "contains({0}, '@')")}, "found").collect()
    for r in out:
        assert [r.text[x.s : x.e] for x in r.found.mail] == [x.m for x in r.found.mail] == [w for w in r.text.split() if "@" in w]


def test_secret_forms(spark):
    draw = random.Random(3)
    some = lambda n: "".join(draw.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    forms = ["export API_KEY={}", "password={}", "password: {}", "DB_PASSWORD={}", "https://x.org/a?token={}&b=1", 'secret = "{}"', "auth_token: {}", "Authorization: Bearer {}", "AWS_SECRET_ACCESS_KEY={}", "{}"]
    values = [some(40), some(32), some(16), "hunter2xK9!", some(30), some(10), some(8), some(40), some(40), "".join(c for c in some(160) if c.isalpha())[:66] + "7" + some(20)]
    plain = ["the secret of happiness is something", "password: required for everyone", f"commit {'9f8a7b6c' * 5} fixes", "key features include performance", "token=$API_TOKEN_VALUE", f"sha256: {'8f010b8e' * 8}", "see /usr/local/lib/python3/site-packages/foo2", "password = getpass()", "author: Wolfgang Amadeus"]
    rows = [(i, t, "app.py") for i, t in enumerate([*(f.format(v) for f, v in zip(forms, values, strict=True)), *plain])]
    got = {r.doc_id: [r.text[x.s : x.e] for x in r.secrets] for r in secret_scan.find_secrets(spark.createDataFrame(rows, "doc_id int, text string, source string")).collect()}
    assert got == {i: [values[i]] if i < len(values) else [] for i in range(len(rows))}


def test_forest_in_sql_equals_trees(spark):
    trees, _ = secret_scan.model(spark)
    x = np.random.default_rng(1).random((300, len(secret_scan.FEATURES))) * np.array([60, *[1] * (len(secret_scan.FEATURES) - 1)])
    names = [f"f{j}" for j in range(x.shape[1])]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], ["i", *names])
    got = [r.s for r in df.selectExpr("i", f"{secret_scan.forest_sql(trees, 'f{}')} AS s").orderBy("i").collect()]
    assert np.allclose(got, np.mean([predict(t, x) for t in trees], axis=0))


def test_quality_scores_by_hand(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = quality.fit_quality(docs, spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    rows = docs.select("doc_id", "text").collect()
    want = model.score(quality.text_features(pa.array([r.text for r in rows])))
    got = {r.doc_id: r.score for r in quality.score_quality(docs, model).collect()}
    assert np.allclose([got[r.doc_id] for r in rows], want) and ((want >= 0) & (want <= 1)).all()


def test_empty_encode(spark):
    import public_tokenizers

    df = spark.createDataFrame([(1, "", "x")], "doc_id int, text string, decoded string").where("false")
    assert bpe.bpe_encode(df, tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).count() == 0


def test_stored_tensors_have_one_shape(spark):
    docs = spark.createDataFrame([(i, "ab " * n) for i, n in enumerate((0, 1, 400, 9000))], "doc_id int, text string").select("doc_id", audio.payload(F.col("text")).alias("payload"))
    media = audio.store_pcm(docs)
    plain = {r.doc_id: r for r in audio.audio_features(media).collect()}
    for r in audio.audio_features(media, stored=True).collect():
        table, want = audio.read_tensors(r.tensors), plain[r.doc_id].tensors
        assert table.schema.field("data").type == pa.fixed_shape_tensor(pa.float32(), [audio.TENSOR_FRAMES, audio.BANDS]) and table.num_rows == r.n_tensors == len(want)
        assert table["start_s"].to_pylist() == [x.start_s for x in want] and table["stop_s"].to_pylist() == [x.stop_s for x in want]
        assert np.allclose(table["data"].combine_chunks().to_numpy_ndarray().reshape(len(want), -1), [x.data for x in want])
        x = audio.features(bytes(r.samples), audio.RATE, audio.UP, audio.DOWN, audio.FRAME, audio.BANDS, audio.TENSOR_FRAMES, 1.05, 0.95)
        assert len(x[0]) == r.n_frames and np.allclose(np.round(x[0].mean(axis=0), 2), r.mel_mean)
