import hashlib
import random
import re
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

import corpus_pipeline
from strandweave.llm import lines, queries
from strandweave.llm.lines import dedup_lines, linked_lines
from strandweave.llm.scan import mix, word_hash


def word_set(line):
    return frozenset(re.findall(r"[a-z0-9\u0080-\U0010ffff]+", line.lower()))


def brute_force(rows, threshold=0.8, least=5):
    """Every line against every earlier one."""
    lines = sorted(((d, i, word_set(t)) for d, text in rows for i, t in enumerate((text or "").split("\n"))), key=lambda x: x[:2])
    index, removed, seen = {}, set(), []
    for d, i, s in lines:
        if len(s) < least:
            continue
        near = {k for w in s for k in index.get(w, ())}
        if any(seen[k][0] < (d, i) and len(s & seen[k][1]) >= threshold * len(s | seen[k][1]) - 1e-9 for k in near):
            removed.add((d, i))
        for w in s:
            index.setdefault(w, []).append(len(seen))
        seen.append(((d, i), s))
    return {d: "\n".join(t for i, t in enumerate((text or "").split("\n")) if (d, i) not in removed) for d, text in rows}


def result(spark, rows, schema="doc_id bigint, text string"):
    return {r["doc_id"]: r["text"] for r in dedup_lines(spark.createDataFrame(rows, schema)).collect()}


def test_random_lines_equal_brute_force(spark):
    draw = random.Random(5)
    base = [[f"w{draw.randrange(60)}" for _ in range(draw.randrange(3, 60))] for _ in range(25)]
    rows = []
    for d in range(80):
        lines = []
        for _ in range(draw.randrange(0, 6)):
            line = list(draw.choice(base))
            for _ in range(draw.randrange(0, 4)):
                line[draw.randrange(len(line))] = f"w{draw.randrange(400)}"
            lines.append(" ".join(line))
        rows.append((d, "\n".join(lines)))
    assert result(spark, rows) == brute_force(rows)


def test_documents_equal_brute_force(spark):
    table = pq.read_table("/root/testdata/sf0.001/documents.parquet")
    rows = list(zip(table["doc_id"].to_pylist(), table["text"].to_pylist(), strict=True))
    assert result(spark, rows) == brute_force(rows)


def test_group_of_like_lines(spark):
    words = [f"word{i}" for i in range(40)]
    rows = [(d, " ".join([*words[:38], f"own{d}", f"tail{d}"])) for d in range(300)] + [(1000, "one two three four\nalpha beta gamma delta epsilon")]
    got = result(spark, rows)
    assert got[0] == rows[0][1] and all(got[d] == "" for d in range(1, 300)) and got[1000] == rows[-1][1]


def test_edges(spark):
    long = " ".join(f"x{i}" for i in range(40_000))
    rows = [(1, None), (2, ""), (3, "a b c d e f"), (4, "F e d c b a!\nkept"), (5, long), (6, long), (None, "g h i j k l"), (7, "g h i j k l"), (8, "m n o p q r"), (8, "m n o p q r")]
    df = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id bigint, text string, n_lines int, source string")
    out = dedup_lines(df)
    assert out.columns == ["doc_id", "text", "source", "n_lines", "n_removed", "n_near", "first_doc"]
    got = sorted(((r["doc_id"] or 0), r["text"], r["n_removed"]) for r in out.collect() if r["text"] is not None)
    assert got == sorted([(2, "", 0), (3, "a b c d e f", 0), (4, "kept", 1), (5, long, 0), (6, "", 1), (0, "g h i j k l", 0), (7, "", 1), (8, "m n o p q r", 0), (8, "m n o p q r", 0)])
    assert dedup_lines(df.where("false")).count() == 0


def test_short_lines_equal_brute_force(spark):
    draw = random.Random(8)
    rows = [(d, "\n".join(" ".join(f"w{draw.randrange(9)}" for _ in range(draw.randrange(0, 7))) for _ in range(6))) for d in range(60)]
    rows += [(100, "All rights reserved.\n--\n\na b c d"), (101, "All rights reserved.\n--\n\na b c d e"), (102, "reserved: all rights\na b c\na b c d e f")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r["doc_id"]: r["text"] for r in dedup_lines(df, least=1).collect()} == brute_force(rows, least=1)


def test_registered_query_takes_short_lines(spark, tmp_path):
    rows = [(1, "All rights reserved.\nIetzte."), (2, "All rights reserved.\nother words"), (3, "Ietzte.")]
    spark.createDataFrame([(*r, "en", "s", len(r[1])) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["kept_sha256"] for r in queries.op10_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {d: hashlib.sha256(t.encode()).hexdigest() for d, t in [(1, rows[0][1]), (2, "other words"), (3, "")]}
    kept = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_stage(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)).collect()}
    assert kept == {1: rows[0][1], 2: "other words"}


def brute_links(rows, threshold=0.8):
    """class_id and n_links of each document, from every pair of distinct word sets."""
    own = {d: [s for t in (text or "").split("\n") if (s := word_set(t))] for d, text in rows}
    times = Counter(s for x in own.values() for s in x)
    sets, index, alike = list(times), {}, {s: set() for s in times}
    for s in sets:
        for o in {o for w in s for o in index.get(w, ())}:
            if len(s & o) >= threshold * len(s | o) - 1e-9:
                alike[s].add(o)
                alike[o].add(s)
        for w in s:
            index.setdefault(w, []).append(s)
    top = {x: x for x in [*own, *sets]}

    def root(x):
        while top[x] != x:
            top[x] = x = top[top[x]]
        return x

    for a, b in [*((d, s) for d, x in own.items() for s in x), *((s, o) for s in sets for o in alike[s])]:
        top[root(a)] = root(b)
    lowest = {}
    for d in sorted(own):
        lowest.setdefault(root(d), d)
    return {d: (lowest[root(d)], sum(times[s] > 1 for s in x) + sum(len(alike[s]) for s in set(x))) for d, x in own.items()}


def linked(spark, rows):
    out = linked_lines(spark.createDataFrame(rows, "doc_id bigint, text string"), least=1).collect()
    return {r["doc_id"]: (r["class_id"], r["n_links"]) for r in out}, {r["doc_id"]: r["text"] for r in out}


def test_links_of_chains(spark):
    a = [f"w{i}" for i in range(10)]
    b, c = [*a[1:], "x"], [*a[2:], "x", "y"]  # b is like a and like c, c isn't like a
    rows = [(1, " ".join(a)), (2, " ".join(c)), (3, " ".join(b)), (4, " ".join(b) + "\nq r"), (5, "q r"), (6, "alone"), (7, None)]
    got, kept = linked(spark, rows)
    assert got == {1: (1, 1), 2: (1, 1), 3: (1, 3), 4: (1, 4), 5: (1, 1), 6: (6, 0), 7: (7, 0)} == brute_links(rows)
    assert {d: t or None for d, t in kept.items()} == {1: rows[0][1], 2: rows[1][1], 3: None, 4: "q r", 5: None, 6: "alone", 7: None}


def test_links_equal_brute_force(spark):
    table = pq.read_table("/root/testdata/sf0.001/documents.parquet")
    rows = list(zip(table["doc_id"].to_pylist(), table["text"].to_pylist(), strict=True))
    got, kept = linked(spark, rows)
    assert got == brute_links(rows) and kept == brute_force(rows, least=1)


def test_unrelated_lines_of_a_word_stay_apart():
    """Lines that share a rare word and nothing else: if the filters let them pass, the groups of a large input grow into one."""
    draw = random.Random(4)
    rank = np.ones(lines.CELLS, np.uint8)
    rank[int(mix(np.array([word_hash("shared")], np.uint64))[0]) % lines.CELLS] = 0
    for n in (13, 20, 40, 56, 96, 160, 200, 400):
        texts = [" ".join(["shared", *(f"w{draw.randrange(10**9)}" for _ in range(n - 1))]) for _ in range(600)]
        near = " ".join(["shared", *(f"v{i}" for i in range(n - 1))])
        batch = pa.record_batch({"doc": list(range(602)), "text": [*texts, near, near + " more"]})
        blocks = pa.Table.from_batches(lines._prefixes(iter([batch]), SimpleNamespace(value=rank), 0.8, 1, 1))
        assert sum(links.num_rows for links in lines._forest(iter(blocks.to_batches()), 0.8)) == 1
