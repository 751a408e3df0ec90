"""The stages of the corpus pipeline, each on what the one before kept."""

from __future__ import annotations

import corpus_pipeline
from cliqueflow.llm import pii

from . import brute


def test_stages(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").limit(400)
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality_rules"](spark, docs, sf_small)
    good = spark.read.parquet(f"{sf_small}/labels.parquet").filter("quality = 1")
    lost = docs.join(good, "doc_id").join(kept, "doc_id", "left_anti").collect()
    assert all(len(brute.WORD.findall(r.text)) < 20 for r in lost)

    rows = [(r.doc_id, r.text) for r in kept.select("doc_id", "text").collect()]
    one = stages["near_duplicates"](spark, kept, sf_small)
    least = {c if c is not None else i for i, _, c in brute.components(rows, corpus_pipeline.SHINGLE, corpus_pipeline.PERCENT)[0]}
    assert {r.doc_id for r in one.select("doc_id").collect()} == least

    before = {r.doc_id: r.text for r in one.collect()}
    after = {r.doc_id: r for r in stages["repeated_passages"](spark, one, sf_small).collect()}
    for i, n, gone, _ in brute.substring_dedup(sorted(before.items())):
        assert len(brute.WORD.findall(after[i].text)) == n - gone
        assert gone or after[i].text == before[i]

    clean = stages["personal_data"](spark, one, sf_small)
    assert clean.columns == docs.columns
    assert pii.find_pii(clean).filter("size(filter(_spans, x -> x.k = 0)) > 0").count() == 0
    packed = stages["packing"](spark, clean, sf_small)
    assert packed.groupBy("doc_id").sum("length").count() == clean.count()


def test_repeated_passages_keep_clashing_columns(spark):
    words = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(1, words, "a", 7), (2, words + " z", "b", 8)], "doc_id long, text string, kept string, N_Words int")
    out = corpus_pipeline.repeated_passages(spark, docs, "")
    assert out.columns == docs.columns
    assert [tuple(r) for r in out.orderBy("doc_id").collect()] == [(1, words, "a", 7), (2, "z", "b", 8)]
