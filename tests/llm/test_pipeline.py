"""The pipeline's stages against brute force on a small corpus."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_pairs import _brute_components, _brute_leaks
from wardlens.llm import bpe
from wardlens.llm.common import Workspace
from wardlens.llm.tokens import rank_encoding

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    parts = _brute_components(list(before.items()))
    kept = {d: t for d, t in before.items() if parts[d][2]}
    leaks = _brute_leaks(list(kept.items()), items, 10)
    want = {d for d in kept if not leaks[d][4]}
    extra = docs.withColumn("key", F.lit("k")).withColumn("n_card", F.lit("c"))
    work, seen = Workspace(spark, "test"), extra
    for name, stage in corpus_pipeline.STAGES:
        columns = seen.columns
        seen = work.keep(stage(spark, seen, SF), name)
        if name == "pii":
            clean = {r.doc_id: r.text for r in seen.collect()}
        if name != "bpe":
            assert seen.columns == columns, name
    assert set(clean) == want
    assert sum(clean[d] != before[d] for d in want) < len(want) / 5
    reference = rank_encoding(bpe.RANKS, bpe.PATTERN)
    for r in seen.collect():
        assert r.text == clean[r.doc_id]
        assert r.ids == reference.encode_ordinary(r.text) and r.n_tokens == len(r.ids)


def test_stages_with_odd_rows(spark):
    rows = [(1, None, None, None, None), (None, "the of and with that this", "en", "s", 3),
            (3, "the of and with that this", "en", "s", 3), (4, "the of and with that this", "en", "s", 3),
            (4, "the of and with that this", "en", "s", 3), (5, "", "en", None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    counts = {}
    work = Workspace(spark, "test")
    for name, stage in corpus_pipeline.STAGES:
        docs = work.keep(stage(spark, docs, SF), name)
        counts[name] = docs.count()
    assert counts == {"language_id": 4, "near_dedup": 2, "decontaminate": 2, "pii": 2, "bpe": 2}
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, SF)
        assert none.count() == 0
