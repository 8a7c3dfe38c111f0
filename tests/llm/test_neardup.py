import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from strandweave.llm import neardup


def shingles(text):
    w = re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (text or "").lower())
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None


def brute_force(rows, threshold=0.8):
    """Components over all pairs, by union-find."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        for j in {j for g in s or () for j in where.get(g, ())}:
            if len(s & sets[j]) >= threshold * len(s | sets[j]) - 1e-9:
                root[find(i)] = find(j)
        for g in s or ():
            where.setdefault(g, []).append(i)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), d), d)
    return {d: low[find(i)] for i, (d, _) in enumerate(rows)}


def result(spark, rows):
    return {r["doc_id"]: r["class_id"] for r in neardup.near_classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}


def test_documents_equal_brute_force(spark):
    table = pq.read_table("/root/testdata/sf0.01/documents.parquet")
    rows = list(zip(table["doc_id"].to_pylist(), table["text"].to_pylist(), strict=True))
    got, want = result(spark, rows), brute_force(rows)
    assert got == want and len(set(want.values())) < len(rows)


def test_large_groups_and_chains(spark):
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(120)]
    rows = [(i, " ".join(base)) for i in range(50)]
    for i in range(60):  # near copies of one text
        copy = list(base)
        copy[draw.randrange(120)] = word()
        rows.append((100 + i, " ".join(copy)))
    link = [word() for _ in range(200)]
    for i in range(30):  # a chain: each text replaces some words of the one before
        rows.append((500 + i, " ".join(link)))
        link = list(link)
        link[(7 * i) % 200] = word()
        link[(7 * i + 3) % 200] = word()
    passage = [word() for _ in range(60)]
    for i in range(60):  # unlike texts that share a passage
        rows.append((800 + i, " ".join([*passage, *[word() for _ in range(40)]])))
    assert result(spark, rows) == brute_force(rows)


def test_edges(spark):
    long = " ".join(f"x{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, "..."), (4, "one two"), (5, "One, two!"), (6, "two one"), (7, long), (8, long + " end"), (9, long), (9, long)]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id bigint, text string, class_id int")
    got = sorted((r["doc_id"], r["class_id"], r["n_class"]) for r in neardup.near_classes(df).collect())
    assert got == [(1, 1, 1), (2, 2, 1), (3, 3, 1), (4, 4, 2), (5, 4, 2), (6, 6, 1), (7, 7, 4), (8, 7, 4), (9, 7, 4), (9, 7, 4)]
    assert neardup.near_classes(df.where("false")).count() == 0


def test_signature_estimates_probability_jaccard():
    draw = random.Random(1)
    a = [f"a{draw.randrange(10**6)}" for _ in range(400)]
    b = a[:300] + [f"b{i}" for i in range(100)]
    s = neardup.Shingles(pa.array([" ".join(a * 2), " ".join(b)]))
    held = neardup.signatures(s, 4096, np.arange(2))
    sets = [dict(zip(s.gram[s.first[i] : s.first[i + 1]].tolist(), (1 + np.log(s.count[s.first[i] : s.first[i + 1]])).tolist(), strict=True)) for i in range(2)]
    both = set(sets[0]) & set(sets[1])
    every = [(sets[0].get(k, 0.0), sets[1].get(k, 0.0)) for k in set(sets[0]) | set(sets[1])]
    exact = sum(1 / sum(max(u / sets[0][k], v / sets[1][k]) for u, v in every) for k in both)
    assert abs((held[0] == held[1]).mean() - exact) < 0.03
