"""Cases that every operator and stage has to take: empty tables, nulls, very long texts, repeats, clashing columns."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from cliqueflow.llm import catalog, jaccard_join, kneser_ney, lm_scoring, packing, pieces, pii, quality_rules, topk, toxicity
from cliqueflow.llm.blocks import by_shard, each_block, write_blocks

from . import brute

DOCS = "doc_id long, text string, lang string"
LABELS = "doc_id long, quality int, toxic int"
#: Their rows come from training, from libraries or from recursion; tests hold them against plain versions or held-out labels.
WITHOUT_SQL = {
    "op2_pii", "op3_pieces", "op4_toxicity", "op5_quality_classifier", "op6_quality_rules",
    "op7_packing", "op8_lm_scoring", "op11_alignment", "pipeline",
}


def test_every_query_has_sql_or_a_plain_version():
    registered = {n for n in __spark_entry__.queries() if n in catalog.QUERIES or n == "pipeline"}
    assert registered - set(__spark_entry__.oracle_sql()) == WITHOUT_SQL


def documents():
    rng = random.Random(11)
    words = ["the", "of", "é", "a@b.co", "4111 1111 1111 1111", "$", "\n", "😀"] + [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60))), rng.choice(["en", "de", None])) for i in range(80)]
    rows += [(100, None, "en"), (101, "", "en"), (102, " \n", None), (None, "the of the of", "en"), (None, None, None)]
    rows += [(103, " ".join(rng.choice(words) for _ in range(60_000)), "en"), rows[3], rows[3]]
    return rows


def labels(spark, rows):
    return spark.createDataFrame([(r[0], i % 3 > 0, i % 2) for i, r in enumerate(rows)], "doc_id long, quality boolean, toxic int").withColumn(
        "quality", F.col("quality").cast("int")
    )


def scored(df, lab):
    return toxicity.score(df, toxicity.fit(df, lab, lambda k: k.isNotNull()))


#: name -> (rows of documents and labels, a column of the result's own that the documents may have as well)
OPERATORS = {
    "pii": (lambda df, lab: pii.find_pii(df), "_spans"),
    "pieces": (lambda df, lab: pieces.encode_texts(df, pieces.model_path()), "ids"),
    "toxicity": (scored, "score"),
    "kneser_ney": (kneser_ney.classify, "kept"),
    "quality_rules": (lambda df, lab: quality_rules.judge(df, quality_rules.learn_rules(df, lab)), "_words"),
    "packing": (lambda df, lab: packing.pack(df, *packing.vocabulary_files()).groupBy("doc_id").agg(F.count("*")), "length"),
    "lm_scoring": (lambda df, lab: lm_scoring.score_texts(df, lm_scoring.fold(F.col("doc_id")) == 2), "n_tokens"),
    "jaccard_join": (lambda df, lab: jaccard_join.linked_components(df), "component_id"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operators_take_every_row(spark, name):
    work, clash = OPERATORS[name]
    rows = documents()
    df = spark.createDataFrame([(*r, 7) for r in rows], f"{DOCS}, {clash} int").repartition(3)
    got = work(df, labels(spark, rows))
    assert got.count() == (len({r[0] for r in rows}) if name == "packing" else len(rows))
    assert work(df.limit(0), labels(spark, rows).limit(0)).count() == 0


def test_vectors_of_an_empty_table_and_with_clashing_columns(spark):
    df = spark.createDataFrame([(100, [1.0, 2.0], 1.0, "x"), (1, [2.0, 0.5], 2.0, "y")], "vec_id long, embedding array<double>, length double, ints string")
    vectors = topk.scaled(df, "vec_id", "embedding", 1024)
    assert [tuple(r) for r in topk.top_k(vectors, vectors.filter("id = 100"), 3).collect()] == [(100, 1, 1, 2048 * 1024 + 512 * 2048)]
    empty = topk.scaled(df.limit(0), "vec_id", "embedding", 1024)
    assert topk.top_k(empty, empty, 3).count() == 0


CLASHING = "_words string, _lines int, _stats int, _base_failed int, _kept string, _spans int, kept string, n_removed int, label int, _text int, _k0 int"


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_keep_clashing_columns_and_take_empty_tables(spark, sf_small, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    rows = documents()
    own = ("q", 1, 2, 3, "k", 5, "z", 6, 8, 9, 10)
    df = spark.createDataFrame([(*r, "s", len(r[1] or ""), *own) for r in rows], f"{DOCS}, source string, n_chars long, {CLASHING}")
    out = stage(spark, df, sf_small)
    if name != "packing":
        assert out.columns == df.columns
        got = out.collect()
        assert got and all(tuple(r)[5:] == own for r in got)
    empty = stage(spark, df.limit(0), sf_small)
    assert empty.count() == 0 and (name == "packing" or empty.columns == df.columns)


@pytest.mark.parametrize("percent", [50, 60, 66])
def test_links_over_several_bands(spark, percent):
    rng = random.Random(percent)
    rows = []
    for n in range(60):
        base = [f"{n}x{i}" for i in range(18)]
        rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(base + [f"{n}y{i}" for i in range(rng.randint(6, 14))]))]
    got = jaccard_join.linked_components(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent)
    want = brute.components(rows, 3, percent)[0]
    assert sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect())) == sorted(want)


def test_copies_of_the_quality_model_give_the_same_scores(spark):
    rows = documents()
    df, lab = spark.createDataFrame(rows, DOCS), labels(spark, rows)
    one = sorted(map(tuple, kneser_ney.perplexities(df, lab).collect()), key=str)
    three = sorted(map(tuple, kneser_ney.perplexities(df, lab, docs_per_copy=len(rows) // 3 + 1).collect()), key=str)
    assert [r[:3] for r in one] == [r[:3] for r in three]
    assert all(abs(a[3] - b[3]) < 1e-3 for a, b in zip(one, three))


def test_a_task_walks_many_shards(spark):
    rows = [(" ".join(f"v{i * 31 % 977}x{j}" for j in range(200)), False) for i in range(300)]
    blocks = write_blocks(spark.createDataFrame(rows, "text string, _held boolean").repartition(2), "text")
    asked = each_block(blocks, lm_scoring.ask_counts(500, "text"), "shard long, block long, blob binary, n long")
    dealt = by_shard(asked).withColumn("task", F.spark_partition_id())
    tasks = dealt.groupBy("task").agg(F.count_distinct("shard").alias("shards")).collect()
    assert len(tasks) <= int(spark.conf.get("spark.sql.shuffle.partitions")) and sum(r.shards for r in tasks) == 500
    # so the answers are those of a task for each shard
    answers = by_shard(asked).mapInArrow(lm_scoring.answer_counts, lm_scoring.ANSWERS)
    alone = asked.repartition(500, "shard").sortWithinPartitions("shard").mapInArrow(lm_scoring.answer_counts, lm_scoring.ANSWERS)
    assert sorted(map(tuple, answers.collect())) == sorted(map(tuple, alone.collect()))
