"""Quality rules as learned decision lists (DataFrame functions only).

``text_stats`` measures a text inside Spark expressions. ``learn_rules`` takes
a bounded sample of labelled statistics and grows an ordered list of threshold
conjunctions by sequential covering (grow on two thirds by information gain,
prune on the rest); ``verdict`` turns the list into one conditional expression.

Defined cases: a null or empty text has no words, fails the base rule and is
not kept; repeated rows are each judged; other columns pass through unchanged,
but for those with a name in ``ADDED``, which are replaced; an empty label
table gives an empty rule list (the base rule alone decides).
Windows are compared by the 64-bit hash of their eight words.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .columns import free_name

#: What ``judge`` adds.
ADDED = ("_stats", "_base_failed", "_kept")
WINDOW = 8
SYMBOLS = "#*$%&|<>"
SPACE = r"[\x09-\x0D\x20]+"
#: Labelled rows that the learner sees at most.
MAX_LABELLED = 6000
#: A rule stands only if at least this share of what it covers is labelled bad.
MIN_PRECISION = 0.97
MIN_COVER = 25
MAX_CONDITIONS = 3
CUTS = 24


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def repeated_words(words: Column) -> Column:
    """Words that lie in a window found twice or more in the array (its first occurrence included)."""

    def positions(sorted_windows: Column) -> Column:
        n = F.size(sorted_windows)
        twin = F.filter(
            sorted_windows,
            lambda e, i: ((i > 0) & (F.get(sorted_windows, i - 1)["h"] == e["h"]))
            | ((i + 1 < n) & (F.get(sorted_windows, i + 1)["h"] == e["h"])),
        )
        return F.sort_array(F.transform(twin, lambda e: e["p"]))

    def covered(at: Column) -> Column:
        return F.aggregate(
            at,
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto")),
            lambda a, p: F.struct(
                (a["n"] + p + WINDOW - F.greatest(a["upto"], p)).alias("n"), (p + WINDOW).alias("upto")
            ),
            lambda a: a["n"],
        )

    def count(hashes: Column) -> Column:
        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p")))
        return F.when(
            F.size(F.array_distinct(hashes)) < F.size(hashes),
            covered(let(F.sort_array(pairs), positions)),
        ).otherwise(F.lit(0).cast("long"))

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))

    return let(
        words,
        lambda w: F.when(F.size(w) > WINDOW, let(windows(w), count)).otherwise(F.lit(0).cast("long")),
    )


def text_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``_stats``: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_distinct."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda s: s.rlike(r"[^\x09-\x0D\x20]"))
    held = [free_name(docs.columns, c) for c in ("_words", "_lines")]
    with_words = docs.withColumn(held[0], words_of(F.col(text))).withColumn(held[1], lines)
    w, lines = F.col(held[0]), F.col(held[1])
    return with_words.withColumn(
        "_stats",
        F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            (F.char_length(body) - F.char_length(F.regexp_replace(body, r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            repeated_words(w).alias("n_repeat_words"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
        ),
    ).drop(*held)


def features(stats: Column) -> dict[str, Column]:
    """Named features of a rule; a text without words has 0 everywhere."""
    words = F.greatest(stats["n_words"], F.lit(1))
    return {
        "n_words": stats["n_words"].cast("double"),
        "mean_word_chars": stats["word_chars"] / words,
        "symbols_per_word": stats["n_symbols"] / words,
        "dup_line_share": stats["n_dup_lines"] / F.greatest(stats["n_lines"], F.lit(1)),
        "repeat_share": stats["n_repeat_words"] / words,
        "distinct_share": stats["n_distinct"] / words,
        "words_per_line": stats["n_words"] / F.greatest(stats["n_lines"], F.lit(1)),
    }


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < 20) | (stats["n_repeat_words"] * 100 > stats["n_words"] * 30)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # feature > cut, else feature <= cut
    cut: float

    def column(self, feats: dict[str, Column]) -> Column:
        return feats[self.feature] > self.cut if self.above else feats[self.feature] <= self.cut


@dataclass(frozen=True)
class Rule:
    """A conjunction that rejects; ``bad`` of the ``covered`` labelled rows it met were bad."""

    conditions: tuple[Condition, ...]
    covered: int
    bad: int


def grow_rules(rows: list[dict[str, float]], bad: list[bool]) -> list[Rule]:
    """Sequential covering over labelled feature rows (bounded by the caller)."""
    if not rows:
        return []
    masks: dict[Condition, int] = {}
    for f in rows[0]:
        values = sorted({r[f] for r in rows})
        step = max(1, len(values) / CUTS)
        for cut in {values[min(len(values) - 1, int(i * step))] for i in range(CUTS)}:
            over = sum(1 << i for i, r in enumerate(rows) if r[f] > cut)
            masks[Condition(f, True, cut)] = over
            masks[Condition(f, False, cut)] = ((1 << len(rows)) - 1) & ~over
    is_bad = sum(1 << i for i, b in enumerate(bad) if b)
    prune_set = sum(1 << i for i in range(0, len(rows), 3))
    left = (1 << len(rows)) - 1
    rules: list[Rule] = []
    while True:
        grown = _grow(masks, is_bad, left & ~prune_set)
        grown = _prune(grown, masks, is_bad, left & prune_set)
        mask = left
        for c in grown:
            mask &= masks[c]
        n, p = mask.bit_count(), (mask & is_bad).bit_count()
        if not grown or n < MIN_COVER or p < MIN_PRECISION * n:
            return rules
        rules.append(Rule(tuple(_margin(c, rows, mask, left & ~is_bad) for c in grown), n, p))
        left &= ~mask


def _grow(masks: dict[Condition, int], is_bad: int, within: int) -> list[Condition]:
    chosen: list[Condition] = []
    while len(chosen) < MAX_CONDITIONS:
        n, p = within.bit_count(), (within & is_bad).bit_count()
        if not p or p == n:
            break
        best, gain = None, 0.0
        for c, mask in masks.items():
            n1, p1 = (within & mask).bit_count(), (within & mask & is_bad).bit_count()
            if p1 and (g := p1 * (math.log2(p1 / n1) - math.log2(p / n))) > gain + 1e-12:
                best, gain = c, g
        if best is None:
            break
        chosen.append(best)
        within &= masks[best]
    return chosen


def _prune(grown: list[Condition], masks: dict[Condition, int], is_bad: int, within: int) -> list[Condition]:
    def worth(conditions: list[Condition]) -> float:
        mask = within
        for c in conditions:
            mask &= masks[c]
        n, p = mask.bit_count(), (mask & is_bad).bit_count()
        return (2 * p - n) / n if n else -1.0

    return max((grown[:k] for k in range(len(grown), 0, -1)), key=worth, default=[])


def _margin(c: Condition, rows: list[dict[str, float]], covered: int, good: int) -> Condition:
    """The cut half way from the covered rows to the nearest good row beyond it, so texts near the good ones pass."""
    inner = [r[c.feature] for i, r in enumerate(rows) if covered >> i & 1]
    outer = [r[c.feature] for i, r in enumerate(rows) if good >> i & 1 and (r[c.feature] > c.cut) != c.above]
    if not outer:
        return c
    return Condition(c.feature, c.above, (min(inner) + max(outer)) / 2 if c.above else (max(inner) + min(outer)) / 2)


def learn_rules(
    docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", max_labelled: int = MAX_LABELLED
) -> list[Rule]:
    """Rules from at most ``max_labelled`` labelled documents, chosen by the hash of their key."""
    chosen = (
        labels.filter(F.col(key).isNotNull() & F.col("quality").isNotNull())
        .select(F.col(key).alias("_k"), (F.col("quality") == 0).alias("_bad"))
        .orderBy(F.xxhash64("_k"), "_k", "_bad")
        .limit(max_labelled)
    )
    texts = docs.select(F.col(key).alias("_k"), F.col(text).alias("_text"))
    # stored, so that only texts of the sample are measured
    joined = cut_lineage(texts.join(F.broadcast(chosen), "_k"), "labelled")  # max_labelled rows of two numbers
    stats = text_stats(joined, "_text").filter(~base_failed(F.col("_stats")))
    feats = features(F.col("_stats"))
    seen = stats.select("_k", "_bad", *[c.alias(k) for k, c in feats.items()]).orderBy(F.xxhash64("_k"), "_k", "_bad").limit(2 * max_labelled).collect()
    return grow_rules([{k: r[k] for k in feats} for r in seen], [r["_bad"] for r in seen])


def verdict(rules: list[Rule], stats: Column) -> Column:
    """True unless a rule, in order, rejects."""
    feats = features(stats)
    kept = F.lit(True)
    for rule in reversed(rules):
        met = F.lit(True)
        for c in rule.conditions:
            met = met & c.column(feats)
        kept = F.when(met, F.lit(False)).otherwise(kept)
    return kept


def judge(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """``docs`` plus ``_stats``, ``_base_failed`` and ``_kept``."""
    stats = F.col("_stats")
    return (
        text_stats(docs, text)
        .withColumn("_base_failed", base_failed(stats))
        .withColumn("_kept", ~base_failed(stats) & verdict(rules, stats))
    )


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = judge(docs, learn_rules(docs, labels))
    return judged.select(
        "doc_id",
        *[f"_stats.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        F.col("_base_failed").alias("base_failed"),
        F.col("_kept").alias("kept"),
    )
