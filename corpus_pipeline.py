"""Corpus pipeline over ``documents``: quality rules, near duplicates, repeated passages, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of their input. A driver may store each result and
read it again as the next stage's ``docs``; ``run`` chains them through the
session's shared scratch folder in the same way.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliqueflow.llm import pii
from cliqueflow.llm import quality_rules as quality
from cliqueflow.llm import substring_dedup as passages
from cliqueflow.llm.columns import set_apart
from cliqueflow.llm.jaccard_join import keep_one
from cliqueflow.llm.packing import pack, vocabulary_files
from cliqueflow.llm.pii import find_pii, redacted
from cliqueflow.llm.quality_rules import judge, learn_rules
from cliqueflow.llm.substring_dedup import dedup_substrings
from cliqueflow.session import distilled

#: Near duplicates of the second stage: word shingles and least similarity in percent.
SHINGLE = 5
PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned decision list keep."""
    rules = learn_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    apart, own = set_apart(docs, quality.ADDED)
    return judge(apart, rules).filter("_kept").select(*apart.columns).withColumnsRenamed(own)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies."""
    return keep_one(docs, k=SHINGLE, percent=PERCENT)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of windows that a document of a smaller id has; untouched texts stay as they are."""
    apart, own = set_apart(docs, passages.ADDED)
    found = dedup_substrings(apart)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    return with_text(found, text, apart.columns).withColumnsRenamed(own)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every span of personal data replaced by its kind."""
    apart, own = set_apart(docs, pii.ADDED)
    return with_text(find_pii(apart), redacted(F.col("text"), F.col("_spans")), apart.columns).withColumnsRenamed(own)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two pieces of the token ids of every document."""
    return pack(docs, *vocabulary_files())


def with_text(docs: DataFrame, text: F.Column, columns: list[str]) -> DataFrame:
    changed = docs.withColumn("text", text).withColumn("n_chars", F.char_length("text").cast("long"))
    return changed.select(*columns)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: The stages learn, link transitively and tokenise, which SQL cannot express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = distilled(spark, partial(stage, spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
