"""Exact duplicates: rows grouped by a 128-bit content hash, texts of one hash compared byte for byte.

Texts that share a hash are folded where they are equal, before any shuffle;
a hash that is left with two different texts is a collision, and its rows are
told apart by the text itself. Rows of one hash (and text) are a class; the
row of the smallest (or largest) id stays. Native expressions only. A class
may hold most of the table: its count and its kept row come from partial
aggregates, and rows meet them in a join whose large keys Spark can split.

Defined cases: a null text counts as empty, and empty texts are equal; a row
with a null id stays only if no row of its class has an id; of rows with equal
text and id one stays; carried columns pass through unchanged whatever their
names; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

CLASS = ["_hash", "_twin"]


def content_hash(text: Column) -> Column:
    """128 bits of a text's bytes."""
    return F.unhex(F.md5(text.cast("binary")))


def unchanged(text: Column) -> Column:
    return text


def _classed(
    docs: DataFrame, key: str, text: str, keep: tuple[str, ...], largest: bool, normal: Callable, digest: Callable
) -> DataFrame:
    """Carried columns _k0.. of every row with _keep (id that stays), _size, _kept and _sha."""
    body = normal(F.coalesce(F.col(text).cast("string"), F.lit("")))
    carried = [F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)]
    rows = docs.select(*carried, F.col(key).alias("_id"), body.alias("_text")).withColumn("_hash", digest(F.col("_text")))
    texts = rows.select("_hash", "_text").distinct()
    clashes = cut_lineage(texts.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_hash"), "clashes")
    if clashes.isEmpty():
        told = rows.withColumn("_twin", F.lit(""))
    else:
        met = rows.join(clashes.withColumn("_clash", F.lit(True)), "_hash", "left")
        told = met.withColumn("_twin", F.when(F.col("_clash"), F.col("_text")).otherwise(""))
    sha = F.unhex(F.sha2(F.col("_text").cast("binary"), 256)).alias("_sha")
    names = [f"_k{i}" for i in range(len(keep))]
    # stored once, so the row numbers that break ties between equal ids stay the same
    stored = cut_lineage(told.select(*names, "_id", *CLASS, sha, F.monotonically_increasing_id().alias("_row")), "copies")
    if largest:
        best = F.max(F.struct(F.col("_id").isNotNull().alias("o"), F.col("_id").alias("id"), (-F.col("_row")).alias("r")))
    else:
        best = F.min(F.struct(F.col("_id").isNull().alias("o"), F.col("_id").alias("id"), F.col("_row").alias("r")))
    classes = cut_lineage(stored.groupBy(*CLASS).agg(F.count(F.lit(1)).alias("_size"), best.alias("_best")), "classes")
    return stored.join(classes, CLASS).select(
        *names,
        F.col("_best.id").alias("_keep"),
        "_size",
        (F.abs("_best.r") == F.col("_row")).alias("_kept"),
        F.lower(F.hex("_sha")).alias("_sha"),
    )


def find_copies(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    largest: bool = False,
    normal: Callable[[Column], Column] = unchanged,
    digest: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """``keep`` columns of every row plus keep_id, group_size, kept and text_sha256 (of the ``normal`` text)."""
    names = [f"_k{i}" for i in range(len(keep))]
    found = _classed(docs, key, text, keep, largest, normal, digest)
    return found.select(
        *[F.col(n).alias(c) for n, c in zip(names, keep)],
        F.col("_keep").alias("keep_id"),
        F.col("_size").alias("group_size"),
        F.col("_kept").alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", largest: bool = False) -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged."""
    found = _classed(docs, key, text, tuple(docs.columns), largest, unchanged, content_hash).filter("_kept")
    return found.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(docs.columns)])


def op12_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every document; of equal texts the largest id stays."""
    return find_copies(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), largest=True)
