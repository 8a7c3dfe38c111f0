"""The pipeline against plain Python versions of its stages."""

import os
import time
from functools import partial

import numpy as np
import public_tokenizers
import pyarrow as pa

import corpus_pipeline
from strandweave.lineage import shared_folder
from strandweave.llm import bpe, decontaminate, quality
from strandweave.llm.common import materialise
from strandweave.llm.queries import tokenizer_file

from . import test_lines, test_neardup
from .test_small_operators import grams5

SF = "/root/testdata/sf0.001"


def expected(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.fit_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    scores = model.score(quality.text_features(pa.array([t for _, t in rows])))
    rows = [r for r, s in zip(rows, scores, strict=True) if s >= 0.5]
    kept = test_lines.brute_force(rows)
    rows = [(d, kept[d]) for d, t in rows if kept[d] == t or kept[d].strip()]
    groups = test_neardup.brute_force(rows)
    rows = [(d, t) for d, t in rows if groups[d] == d]
    items = []
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        full, front = grams5(r.text), grams5(decontaminate.split_item(r.text)[0])
        items.append((front, full - front or full))
    dirty = lambda t: any(len(a & g) >= 0.5 * len(a) and len(b & g) >= 0.5 * len(b) for g in [grams5(t)] for a, b in items)
    enc = bpe.encoding(tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return {d: (t, enc.encode_ordinary(t)) for d, t in rows if not dirty(t)}


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 40")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == list(corpus_pipeline.COLUMNS) and out.dtypes == docs.dtypes
        assert stage(spark, docs.where("false"), SF).count() == 0
    odd = spark.createDataFrame([(1, None, None, None, None), (1, "", "en", "s", 0), (2, "same words here again now", "en", "s", 25), (2, "same words here again now", "en", "s", 25)], docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, SF).count() >= 2
    assert corpus_pipeline.near_stage(spark, odd, SF).where("doc_id = 2").count() == 1


def test_stages_take_short_lines(spark, monkeypatch):
    """The same stages where every line with a word takes part in line dedup."""
    monkeypatch.setattr(test_lines, "brute_force", partial(test_lines.brute_force, least=1))
    got = {r.doc_id: (r.text, np.frombuffer(r.ids, "<u4").tolist()) for r in corpus_pipeline.run(spark, SF).collect()}
    want = expected(spark)
    assert got == want and 0 < len(want) < spark.read.parquet(f"{SF}/documents.parquet").count()


def shuffle_bytes(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(f.length() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_"))


def test_written_tables_leave_no_shuffle_files(spark):
    before, cleanup = shuffle_bytes(spark), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    out = materialise(spark.range(400_000).repartition(4, "id"), "shuffled")
    until = time.time() + 10
    while shuffle_bytes(spark) > before and time.time() < until:
        time.sleep(0.1)
    assert shuffle_bytes(spark) <= before and out.count() == 400_000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == cleanup


def test_stages_leave_only_the_tables_they_read(spark):
    """Disk must not add up over the steps of a stage, nor over the stages."""
    folder, docs = shared_folder(spark).removeprefix("file:"), spark.read.parquet(f"{SF}/documents.parquet")
    for stage, kind in ((corpus_pipeline.line_stage, "line-removals"), (corpus_pipeline.near_stage, "near-copies")):
        before = set(os.listdir(folder))
        out = stage(spark, docs, SF)
        assert [name.rpartition("-")[0] for name in set(os.listdir(folder)) - before] == [kind]
        assert out.count() > 0
    before = set(os.listdir(folder))
    out = corpus_pipeline.run(spark, SF)
    assert [name.rpartition("-")[0] for name in set(os.listdir(folder)) - before] == ["stage-3"]
    assert out.count() > 0
