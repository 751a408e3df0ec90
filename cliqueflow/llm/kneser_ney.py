"""Quality classifier: interpolated modified Kneser-Ney bigrams trained on trusted text.

Words are kept as they stand; every word of the training text has a number,
words that it does not hold are one unknown word. A bigram is one 64-bit key
(word before, word). Blocks send their bigrams packed to the shard of the word
before; training shards add up counts, and scoring shards hold their part of
the model while the blocks' bigrams stream past it, adding up
log-probabilities per document. What follows an unknown word has its lower
order probability alone, which the block adds itself. A document's perplexity
is kept if it is at most the ``QUANTILE`` of trusted text of its language that
was not trained on.

The model is fitted on every trusted document; the number of its shards grows
with them. The different words of those documents are what is broadcast: a
64-bit hash, by which words are told apart, a number and a probability each.
Defined cases: a null or empty text is its end alone; repeated rows are each
scored; a language without held-out trusted text (or a null one) is kept; an
empty table gives no row; without trusted text every word is equally likely.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, ship_package
from .blocks import BLOCK_BYTES, arrow_of, expand, grouped, pieces, squeeze, text_bytes
from .words import Words

UNKNOWN, END = 0, 1  # the words of the training text are numbered from 2
WORD_BITS = 32
WORD = np.uint64((1 << WORD_BITS) - 1)
#: Word numbers whose continuation counts travel as one row.
PART = 1 << 16
#: Shards of the model of up to ``DOCS_PER_MODEL`` trusted documents; twice as many of them have twice the shards.
#: A shard of so many holds about a million bigrams. Each shard that a block asks sends a sum for each of its
#: documents, so more shards than memory needs cost disk.
SHARDS = 64
DOCS_PER_MODEL = 200_000
#: Bigrams that a shard holds unmerged at least.
MERGED = 1 << 16
#: Level at which what is shuffled and stored is packed.
LEVEL = 9
#: So many ids of trusted documents are broadcast at most.
BROADCAST_IDS = 8_000_000
QUANTILE = 0.995
#: Documents whose bigrams meet one copy of the model.
DOCS_PER_COPY = 400_000
HELD_FOLD = 5
#: Text of a block; larger ones pack better.
TEXT_BYTES = 2 * BLOCK_BYTES
PACKED = "shard long, copy long, kind int, block long, n long, blob binary"
SCORES = "doc_id long, lang string, n_tokens long, log10_prob double"


def planes(values: np.ndarray) -> bytes:
    """Bytes of an array grouped by significance, which compress better."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def unplanes(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8).reshape(size, -1).T.copy().view(kind).ravel()


def pack_arrays(*arrays: np.ndarray) -> bytes:
    return squeeze(b"".join(planes(a) for a in arrays), LEVEL)


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in pieces(batches, "text", BLOCK_BYTES):
        found, n = np.unique(Words(text_bytes(table.column("text"))).hashes(), return_counts=True)
        yield pa.RecordBatch.from_pydict({"hash": pa.array(found.view(np.int64)), "n": pa.array(n, pa.int64())})


@dataclass(frozen=True)
class Vocabulary:
    """Sorted word hashes and the number of each word; frequent words have small numbers, which pack better."""

    hashes: np.ndarray
    numbers: np.ndarray

    @staticmethod
    def of(hashes: np.ndarray, counts: np.ndarray) -> Vocabulary:
        numbers = np.empty(hashes.size, dtype=np.uint32)
        numbers[np.lexsort((hashes, -counts))] = np.arange(2, hashes.size + 2)
        order = np.argsort(hashes)
        return Vocabulary(hashes[order], numbers[order])

    def __len__(self) -> int:
        return self.hashes.size

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(hashes.size, UNKNOWN, dtype=np.uint64)
        if len(self) and hashes.size:
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self) - 1)
            hit = self.hashes[at] == hashes
            out[hit] = self.numbers[at[hit]]
        return out


def key_of(before, word) -> np.ndarray:
    return (np.asarray(before, np.uint64) << np.uint64(WORD_BITS)) | np.asarray(word, np.uint64)


def before_of(keys: np.ndarray) -> np.ndarray:
    return keys >> np.uint64(WORD_BITS)


def word_of(keys: np.ndarray) -> np.ndarray:
    return (keys & WORD).astype(np.int64)


def bigrams(texts: list[bytes], words: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, text) of every token, and the number of tokens of every text."""
    w = Words(texts)
    found, code = np.unique(w.hashes(), return_inverse=True)
    tokens = np.full(len(w) + w.n_texts, END, dtype=np.uint64)
    tokens[np.arange(len(w)) + w.text] = words.lookup(found)[code]
    before = np.concatenate(([np.uint64(END)], tokens[:-1]))  # a text begins behind the end of another
    return key_of(before, tokens), np.repeat(np.arange(w.n_texts), w.counts + 1), w.counts + 1


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (before_of(keys) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % shards


def deltas(keys: np.ndarray) -> np.ndarray:
    """Sorted keys as steps of the word before, each with the step of the word, or the word itself behind a new one."""
    before, word = before_of(keys), keys & WORD
    step = np.diff(before, prepend=np.uint64(0))
    word = np.where(step == 0, np.diff(word, prepend=np.uint64(0)), word)
    return key_of(step, word).astype("<u8")


def keys_of(data: bytes, n: int) -> np.ndarray:
    packed = unplanes(data[: 8 * n], "<u8")
    step, word = before_of(packed), packed & WORD
    new = step != 0
    new[:1] = True
    upto = np.cumsum(word, dtype=np.uint64)
    base = (upto - word)[new]
    return key_of(np.cumsum(step, dtype=np.uint64), upto - base[np.cumsum(new) - 1])


def cuts(shard: np.ndarray) -> list[tuple[int, int]]:
    at = np.concatenate(([0], np.flatnonzero(np.diff(shard)) + 1, [shard.size]))
    return [(a, b) for a, b in zip(at[:-1].tolist(), at[1:].tolist()) if a < b]


def training_counts(shared, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in pieces(batches, "text", TEXT_BYTES):
            keys, _, _ = bigrams(text_bytes(table.column("text")), shared.value)
            keys, counts = np.unique(keys, return_counts=True)
            shard = shard_of(keys, shards)
            order = np.argsort(shard, kind="stable")
            keys, counts, shard = keys[order], counts[order].astype("<u4"), shard[order]
            out = [(int(shard[a]), b - a, pack_arrays(deltas(keys[a:b]), counts[a:b])) for a, b in cuts(shard)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["shard", "n", "blob"])

    return run


def merged(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of all ``runs`` as one."""
    keys, code = np.unique(np.concatenate([k for k, _ in runs]), return_inverse=True)
    return keys, np.bincount(code, weights=np.concatenate([c for _, c in runs])).astype(np.int64)


def add_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per shard: its bigrams with their counts, and how many were seen 1 to 4 times."""
    for shard, rows in grouped(batches, "shard"):
        runs, waiting = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))], 0
        for row in rows:
            data, n = expand(row["blob"]), row["n"]
            runs.append((keys_of(data, n), unplanes(data[8 * n :], "<u4").astype(np.int64)))
            waiting += n
            # merged when as much waits as there is: the shard holds two copies of its part at most, and sorts it a few times
            if waiting > max(MERGED, runs[0][0].size):
                runs, waiting = [merged(runs)], 0
        keys, counts = merged(runs)
        seen = [int((counts == k).sum()) for k in (1, 2, 3, 4)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int64()), pa.array([keys.size], pa.int64()), pa.array([pack_arrays(deltas(keys), counts.astype("<u4"))], pa.binary())]
            + [pa.array([s], pa.int64()) for s in seen],
            names=["shard", "n", "blob", "n1", "n2", "n3", "n4"],
        )


def endings(size: int):
    """How many bigrams of a shard end in each word, a row for each run of ``size`` word numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob, n in zip(batch.column("blob"), batch.column("n").to_pylist()):
                words, seen = np.unique(word_of(keys_of(expand(blob.as_py()), n)), return_counts=True)
                out = []
                for a, b in cuts(words // size):
                    out.append((int(words[a] // size), b - a, pack_arrays((words[a:b] % size).astype("<u4"), seen[a:b].astype("<u4"))))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["part", "n", "blob"])

    return run


def add_endings(size: int):
    """The same of all shards: one row for each run of word numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in grouped(batches, "part"):
            total = np.zeros(size, "<u4")
            for row in rows:
                data, n = expand(row["blob"]), row["n"]
                total[unplanes(data[: 4 * n], "<u4")] += unplanes(data[4 * n :], "<u4")
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "ends": pa.array([squeeze(total.tobytes())], pa.binary())})

    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and more, kept within the count."""
    if not n1 or not n2:
        return 0.5, 0.75, 1.0
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * (n3 / n2), 3 - 4 * y * (n4 / n3) if n3 else 1.0)
    return tuple(float(min(max(d, 0.05), k)) for d, k in zip(raw, (0.95, 1.95, 2.95)))


def discounted(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.select([counts == 0, counts == 1, counts == 2], [0.0, d[0], d[1]], d[2])


@dataclass(frozen=True)
class Lower:
    """What every shard needs besides its bigrams: continuation probabilities and discounts."""

    words: Vocabulary
    unigram: np.ndarray
    discounts: tuple[float, float, float]

    @staticmethod
    def of(words: Vocabulary, ends: np.ndarray, d: tuple[float, float, float]) -> Lower:
        used = len(words) + 2
        n = ends[:used].astype(np.float64)
        total = n.sum()
        if not total:
            probs = np.full(used, 1 / used)
        else:
            own = discounts(*[int((n == k).sum()) for k in (1, 2, 3, 4)])
            cut = discounted(n, own)
            probs = (n - cut) / total + cut.sum() / total / used
        return Lower(words, probs, d)


class ShardModel:
    def __init__(self, n: int, blob: bytes, lower: Lower):
        data = expand(blob)
        self.keys = keys_of(data, n)
        self.counts = unplanes(data[8 * n :], "<u4").astype(np.float64)
        self.lower = lower
        self.cut = discounted(self.counts, lower.discounts)
        before = before_of(self.keys)
        self.contexts, first = np.unique(before, return_index=True)
        self.total = np.add.reduceat(self.counts, first) if first.size else np.zeros(0)
        self.spare = np.add.reduceat(self.cut, first) if first.size else np.zeros(0)

    def log_probs(self, keys: np.ndarray) -> np.ndarray:
        low = self.lower.unigram[word_of(keys)]
        p = low
        if self.keys.size:
            before = before_of(keys)
            c = np.minimum(np.searchsorted(self.contexts, before), self.contexts.size - 1)
            known = self.contexts[c] == before
            at = np.minimum(np.searchsorted(self.keys, keys), self.keys.size - 1)
            seen = np.where(self.keys[at] == keys, self.counts[at] - self.cut[at], 0.0)
            p = np.where(known, (seen + self.spare[c] * low) / self.total[c], low)
        return np.log10(p)


def questions(shared, copies: int, shards: int):
    """Bigram keys with their documents for every shard; below shard 0 a header of the block, and what unknown words precede."""
    schema = arrow_of(PACKED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for n, table in enumerate(pieces(batches, "text", TEXT_BYTES)):
            block = (task << 32) + n
            lower = shared.value
            keys, text, sizes = bigrams(text_bytes(table.column("text")), lower.words)
            alone = before_of(keys) == UNKNOWN
            own = np.bincount(text[alone], weights=np.log10(lower.unigram[word_of(keys[alone])]), minlength=table.num_rows)
            keys, text = keys[~alone], text[~alone]
            shard = shard_of(keys, shards)
            order = np.lexsort((keys, shard))
            keys, text, shard = keys[order], text[order], shard[order]
            kind = "<u2" if table.num_rows <= 1 << 16 else "<u4"
            copy = (block * 0x9E3779B1 >> 7) % copies
            rows = [
                (int(shard[a]), copy, 1, block, b - a, pack_arrays(deltas(keys[a:b]), text[a:b].astype(kind))) for a, b in cuts(shard)
            ]
            head = pa.table({"doc_id": table.column("doc_id"), "lang": table.column("lang"), "n_tokens": pa.array(sizes, pa.int64())})
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, head.schema) as out:
                out.write_table(head)
            home = -1 - block % 64
            rows.append((home, 0, 0, block, table.num_rows, squeeze(sink.getvalue().to_pybytes())))
            rows.append((home, 0, 1, block, table.num_rows, pack_arrays(own.astype("<f4"))))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def score_shards(shared):
    """Partial sums of log-probabilities by document; the model row of a shard comes first, headers pass through."""
    schema = arrow_of("block long, kind int, blob binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lower = shared.value
        model, at = None, None
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                row = {k: batch.column(k)[i].as_py() for k in batch.schema.names}
                if row["shard"] < 0:
                    out.append((row["block"], row["kind"], row["blob"]))
                    continue
                if row["kind"] == 0:
                    model, at = ShardModel(row["n"], row["blob"], lower), (row["shard"], row["copy"])
                    continue
                if at != (row["shard"], row["copy"]):  # nothing was trained in this shard
                    model, at = ShardModel(0, squeeze(b""), lower), (row["shard"], row["copy"])
                data, n = expand(row["blob"]), row["n"]
                keys = keys_of(data, n)
                text = unplanes(data[8 * n :], "<u2" if len(data) == 10 * n else "<u4").astype(np.int64)
                sums = np.bincount(text, weights=model.log_probs(keys))
                out.append((row["block"], 1, pack_arrays(sums.astype("<f4"))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, rows in grouped(batches, "block"):
        head, total = None, None
        for row in rows:
            if row["kind"] == 0:
                head = pa.ipc.open_stream(expand(row["blob"])).read_all()
                total = np.zeros(head.num_rows)
            else:
                part = unplanes(expand(row["blob"]), "<f4")
                total[: part.size] += part
        yield from head.append_column("log10_prob", pa.array(total)).combine_chunks().to_batches()


def trusted_ids(labels: DataFrame, held: bool) -> DataFrame:
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD_FOLD == 0
    return labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull() & (fold if held else ~fold)).select("doc_id").distinct()


def model_shards(trusted: int) -> int:
    """Shards of the model of so many trusted documents."""
    return SHARDS * (trusted // DOCS_PER_MODEL + 1)


def perplexities(docs: DataFrame, labels: DataFrame, docs_per_copy: int = DOCS_PER_COPY, part: int = PART) -> DataFrame:
    """doc_id, lang, n_tokens, log10_prob of every row of ``docs`` (doc_id, text, lang); trained on trusted rows of ``labels``."""
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.col("doc_id").cast("long"), "text", "lang")
    chosen = cut_lineage(trusted_ids(labels, False), "trusted")
    n_chosen = chosen.count()
    shards = model_shards(n_chosen)
    # a long for each trusted document, while they are few enough
    trusted = docs.join(F.broadcast(chosen) if n_chosen <= BROADCAST_IDS else chosen, "doc_id", "left_semi").select("text")
    # sixteen bytes for each different word of the trusted documents
    found = trusted.mapInArrow(count_words, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")).toArrow()
    words = Vocabulary.of(found.column("hash").to_numpy().view(np.uint64), found.column("n").to_numpy())
    numbered = spark.sparkContext.broadcast(words)
    asked = trusted.mapInArrow(training_counts(numbered, shards), "shard long, n long, blob binary")
    model = cut_lineage(
        asked.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(
            add_counts, "shard long, n long, blob binary, n1 long, n2 long, n3 long, n4 long"
        ),
        "bigrams",
    )
    seen = model.agg(*[F.sum(c) for c in ("n1", "n2", "n3", "n4")]).first()
    by_part = model.select("n", "blob").mapInArrow(endings(part), "part long, n long, blob binary")
    added = by_part.repartition("part").sortWithinPartitions("part").mapInArrow(add_endings(part), "part long, ends binary")
    ends = np.zeros(-(-(len(words) + 2) // part) * part, dtype=np.int64)
    for r in added.collect():  # four bytes a numbered word in all
        ends[r["part"] * part : (r["part"] + 1) * part] = np.frombuffer(expand(bytes(r["ends"])), "<u4")
    shared = spark.sparkContext.broadcast(Lower.of(words, ends, discounts(*[x or 0 for x in seen])))
    # a larger model has more shards, so it needs fewer copies: together they grow as the documents do
    copies = -(-SHARDS * (docs.count() // docs_per_copy + 1) // shards)
    parts = model.select(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))).alias("copy"), F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("block"), "n", "blob"
    )
    asked = docs.mapInArrow(questions(shared, copies, shards), PACKED)
    dealt = parts.unionByName(asked).repartition(shards * copies, "shard", "copy").sortWithinPartitions("shard", "copy", "kind")
    sums = dealt.mapInArrow(score_shards(shared), "block long, kind int, blob binary")
    return sums.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(finish, SCORES)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, n_tokens, log10_prob, perplexity, threshold (of the language, null without trusted text), kept."""
    scored = perplexities(docs, labels).withColumn("perplexity", F.pow(F.lit(10.0), -F.col("log10_prob") / F.col("n_tokens")))
    scored = cut_lineage(scored, "perplexity")
    held = scored.join(trusted_ids(labels, True), "doc_id", "left_semi")
    limits = held.groupBy("lang").agg(F.percentile_approx("perplexity", QUANTILE, 10_000).alias("threshold"))
    return scored.join(limits, "lang", "left").select(
        "doc_id",
        "n_tokens",
        "log10_prob",
        "perplexity",
        "threshold",
        F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)).alias("kept"),
    )


def op5_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, log10_prob, perplexity, threshold, kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
