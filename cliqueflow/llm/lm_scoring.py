"""Scoring texts with a log-bilinear neural model trained in numpy by noise-contrastive estimation.

Tokens are words (A-Z lowered) and one end per text. Blocks of documents ask
shards of the vocabulary for the training counts of their words; the counts
give the unigram base score, and the ``VOCABULARY`` most frequent words become
the model's, all others its unknown word, shared out by their counts.

The model predicts a token from the two before it: the sum of two linear maps
of their embeddings, times the token's output embedding, plus a bias that
starts at the unigram log-probability. Every block trains a copy on its
training tokens against shared noise words; the copies are averaged, weighted
by tokens, in ``ROUNDS`` rounds. Because the two context terms add, the
normaliser of every context pair is one matrix product of exponentials, so
scoring is exact normalised lookups.

Defined cases: a null or empty text is its end alone; repeated rows are each
scored (and counted); a null id is in no held-out fold; other columns pass
through; with nothing to learn from the base score is 0; an empty table gives
no row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ..session import cut_lineage
from .blocks import by_shard, each_answered, each_block, expand, grouped, shards, squeeze, text_bytes, unpack_table, with_answers, write_blocks
from .words import Words

VOCABULARY = 2048
DIM = 16
NOISE = 64
BATCH = 512
ROUNDS = 1
RATE = 0.1
SEED = 5
SHARD_BYTES = 3 << 20
CHUNKS = 16
UNKNOWN, END = 0, 1


@dataclass(frozen=True)
class Counts:
    tokens: int  # N: training tokens
    distinct: int  # V: different ones
    ends: int  # training texts
    words: tuple[bytes, ...]  # model words, most frequent first
    word_counts: tuple[int, ...]

    @property
    def unknown_tokens(self) -> int:
        return self.tokens - self.ends - sum(self.word_counts)

    @property
    def unknown_distinct(self) -> int:
        return self.distinct - len(self.words) - (self.ends > 0)

    def unigram(self) -> np.ndarray:
        """Probabilities of unknown, end and the model words."""
        mass = np.array([self.unknown_tokens + self.unknown_distinct + 1, self.ends + 1, *[c + 1 for c in self.word_counts]], dtype=np.float64)
        return mass / mass.sum()


# --- counting: what blocks ask and shards answer -------------------------------------------------


def own_words(texts: list[bytes], n_shards: int) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a block, their codes, and the codes' words ordered by shard: (words, code, shard, word index)."""
    w = Words(texts, lower=True)
    hashes = w.hashes()
    code, first = w.codes(hashes)
    shard = (hashes[first] % np.uint64(n_shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(order.size)
    return w, place[code], shard[order], first[order]


def ask_counts(n_shards: int, text: str) -> Callable[[int, pa.Table], Iterator[dict]]:
    def ask(block: int, rows: pa.Table) -> Iterator[dict]:
        w, code, shard, first = own_words(text_bytes(rows.column(text)), n_shards)
        learn = ~np.array(rows.column("_held").to_pylist(), dtype=bool)
        counts = np.bincount(code[learn[w.text]], minlength=first.size).astype("<i8")
        bounds = np.concatenate(([0], np.flatnonzero(np.diff(shard)) + 1, [shard.size]))
        for a, b in zip(bounds[:-1], bounds[1:]):
            if a < b:
                words = b"\n".join(w.word(i) for i in first[a:b])
                yield {"shard": int(shard[a]), "block": block, "blob": squeeze(counts[a:b].tobytes() + words), "n": int(b - a)}

    return ask


ANSWERS = "block long, shard long, reply binary, distinct long, tokens long"


def answered(shard: int, rows: Iterator[dict]) -> pa.RecordBatch:
    """The replies of one shard; what it takes is freed before the next one."""
    numbers: dict[bytes, int] = {}
    asked, sums = [], []
    for row in rows:
        data = expand(row["blob"])
        own = np.frombuffer(data, dtype="<i8", count=row["n"]).copy()  # not a view, which would hold the words as well
        words = data[8 * row["n"] :].split(b"\n")
        code = np.array([numbers.setdefault(x, len(numbers)) for x in words])
        asked.append((row["block"], code))
        sums.append(own)
    total = np.zeros(len(numbers), dtype=np.int64)
    for (_, code), own in zip(asked, sums):
        total[code] += own  # words of one question differ
    names = list(numbers)
    # ties go to the smaller word, whatever order the questions came in
    floor = np.partition(total, total.size - VOCABULARY)[total.size - VOCABULARY] if total.size > VOCABULARY else 0
    top = sorted(np.flatnonzero(total >= floor).tolist(), key=lambda i: (-total[i], names[i]))[:VOCABULARY]
    head = b"\n".join(b"%d %s" % (total[i], names[i]) for i in top if total[i])
    replies = [(b, squeeze(total[c].astype("<i8").tobytes()), 0, 0) for b, c in asked]
    replies.append((-1, squeeze(head), int((total > 0).sum()), int(total.sum())))
    return pa.RecordBatch.from_pydict(
        {
            "block": pa.array([r[0] for r in replies], pa.int64()),
            "shard": pa.array([shard] * len(replies), pa.int64()),
            "reply": pa.array([r[1] for r in replies], pa.binary()),
            "distinct": pa.array([r[2] for r in replies], pa.int64()),
            "tokens": pa.array([r[3] for r in replies], pa.int64()),
        }
    )


def answer_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One reply per question: the training counts of its words over the corpus. One row more per shard has its totals and top words."""
    for shard, rows in grouped(batches, "shard"):
        yield answered(shard, rows)


def listed_words(reply: bytes) -> list[tuple[int, bytes]]:
    return [(int(n), x) for n, x in (line.split(b" ", 1) for line in expand(reply).split(b"\n") if line)]


def count_levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many top words of each shard have a count of each power of two."""
    for batch in batches:
        for reply in batch.column("reply").to_pylist():
            bits = np.bincount([n.bit_length() - 1 for n, _ in listed_words(reply)])
            seen = np.flatnonzero(bits)
            yield pa.RecordBatch.from_pydict({"level": pa.array(seen, pa.int64()), "n": pa.array(bits[seen], pa.int64())})


def top_words(floor: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for reply in batch.column("reply").to_pylist():
                top = [(n, x) for n, x in listed_words(reply) if n >= floor]
                yield pa.RecordBatch.from_pydict(
                    {"count": pa.array([n for n, _ in top], pa.int64()), "word": pa.array([x for _, x in top], pa.binary())}
                )

    return run


def most_frequent(totals: DataFrame, size: int) -> list:
    """The ``size`` most frequent words of all shards; only those of a count that few enough reach leave their shard."""
    levels = totals.select("reply").mapInArrow(count_levels, "level long, n long").groupBy("level").agg(F.sum("n").alias("n"))
    floor, found = 1, 0
    for r in levels.orderBy(F.desc("level")).collect():  # at most 63 rows
        floor, found = 1 << r["level"], found + r["n"]
        if found >= size:
            break
    head = totals.select("reply").mapInArrow(top_words(floor), "count long, word binary")
    return head.orderBy(F.desc("count"), F.asc("word")).limit(size).collect()


# --- the model -----------------------------------------------------------------------------------


@dataclass
class LogBilinear:
    context: np.ndarray  # words x DIM
    first: np.ndarray  # DIM x DIM, of the token before
    second: np.ndarray  # DIM x DIM, of the one before that
    output: np.ndarray  # words x DIM
    bias: np.ndarray

    @staticmethod
    def start(unigram: np.ndarray) -> LogBilinear:
        rng = np.random.default_rng(SEED)
        n = unigram.size
        draw = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
        eye = np.eye(DIM, dtype=np.float32)
        return LogBilinear(draw(n, DIM), eye * 0.6, eye * 0.4, 0.1 * draw(n, DIM), np.log(unigram).astype(np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.first, self.second, self.output, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def like(self, flat: np.ndarray) -> LogBilinear:
        out, at = [], 0
        for p in self.parts():
            out.append(flat[at : at + p.size].reshape(p.shape).astype(np.float32))
            at += p.size
        return LogBilinear(*out)

    def normalised(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logit tables of the two context places and the log normaliser of every context pair."""
        one = self.context @ self.first @ self.output.T + self.bias
        two = self.context @ self.second @ self.output.T
        shift_one, shift_two = one.max(axis=1, keepdims=True), two.max(axis=1, keepdims=True)
        mass = np.exp(one - shift_one) @ np.exp(two - shift_two).T
        return one, two, np.log(mass) + shift_one + shift_two.T


def add_rows(into: np.ndarray, squares: np.ndarray, rows: np.ndarray, grads: np.ndarray) -> None:
    """One Adagrad step of the rows that a batch touched (gradients of one row summed)."""
    order = np.argsort(rows, kind="stable")
    ordered = rows[order]
    begin = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    total = np.add.reduceat(grads[order], begin, axis=0)
    touched = ordered[begin]
    squares[touched] += (total * total).mean(axis=1) if total.ndim > 1 else total * total
    rate = RATE / np.sqrt(squares[touched])
    into[touched] += total * (rate[:, None] if total.ndim > 1 else rate)


def train_block(model: LogBilinear, contexts: np.ndarray, targets: np.ndarray, unigram: np.ndarray, seed: int) -> LogBilinear:
    """One pass of noise-contrastive estimation over a block's tokens, from ``model``."""
    m = LogBilinear(*[p.copy() for p in model.parts()])
    rng = np.random.default_rng(seed)
    log_noise = (np.log(unigram) + np.log(NOISE)).astype(np.float32)
    ladder = np.cumsum(unigram)
    sq_context, sq_output, sq_bias = (np.full(unigram.size, 1.0, np.float32) for _ in range(3))
    sq_first, sq_second = np.full(m.first.shape, 10.0, np.float32), np.full(m.second.shape, 10.0, np.float32)
    order = rng.permutation(targets.size)
    for at in range(0, targets.size, BATCH):
        pick = order[at : at + BATCH]
        one, two, goal = contexts[pick, 0], contexts[pick, 1], targets[pick]
        noise = np.minimum(np.searchsorted(ladder, rng.random(NOISE)), unigram.size - 1)
        r1, r2 = m.context[one], m.context[two]
        q = r1 @ m.first + r2 @ m.second
        out_goal, out_noise = m.output[goal], m.output[noise]
        odds_goal = (q * out_goal).sum(axis=1) + m.bias[goal] - log_noise[goal]
        odds_noise = q @ out_noise.T + m.bias[noise] - log_noise[noise]
        g_goal = 1 / (1 + np.exp(np.clip(odds_goal, -30, 30)))  # push up
        g_noise = -1 / (1 + np.exp(np.clip(-odds_noise, -30, 30)))  # push down
        dq = g_goal[:, None] * out_goal + g_noise @ out_noise
        d_goal = g_goal[:, None] * q
        d_noise = g_noise.T @ q
        d1, d2 = dq @ m.first.T, dq @ m.second.T
        g1, g2 = r1.T @ dq, r2.T @ dq
        sq_first += g1 * g1
        sq_second += g2 * g2
        m.first += RATE * g1 / np.sqrt(sq_first) * 0.1
        m.second += RATE * g2 / np.sqrt(sq_second) * 0.1
        add_rows(m.context, sq_context, np.concatenate((one, two)), np.concatenate((d1, d2)))
        add_rows(m.output, sq_output, np.concatenate((goal, noise)), np.concatenate((d_goal, d_noise)))
        add_rows(m.bias, sq_bias, np.concatenate((goal, noise)), np.concatenate((g_goal, g_noise.sum(axis=0))))
    return m


class Reader:
    """Turns texts into model tokens with their contexts."""

    def __init__(self, words: tuple[bytes, ...]):
        w = Words([b"\n".join(words)])
        h = w.hashes()
        self.order = np.argsort(h)
        self.sorted = h[self.order]

    def tokens(self, w: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Model ids of all tokens, text by text with the end last; their contexts; the token place of every word."""
        ids = np.full(hashes.size, UNKNOWN, dtype=np.int64)
        if self.sorted.size and hashes.size:
            at = np.minimum(np.searchsorted(self.sorted, hashes), self.sorted.size - 1)
            hit = self.sorted[at] == hashes
            ids[hit] = self.order[at[hit]] + 2
        place = np.arange(hashes.size) + w.text
        stops = w.first[1:] + np.arange(w.n_texts)
        out = np.full(hashes.size + w.n_texts, END, dtype=np.int64)
        out[place] = ids
        before = np.concatenate(([END], out[:-1])) if out.size else out
        two = np.concatenate(([END], before[:-1])) if out.size else out
        starts = np.concatenate(([0], stops[:-1] + 1)) if stops.size else stops
        two[starts] = END
        second = starts[(w.counts > 0)] + 1
        two[second] = END  # the end of the text before is no context
        return out, np.stack((before, two), axis=1), place


@lru_cache(maxsize=2)
def reader(words: tuple[bytes, ...]) -> Reader:
    return Reader(words)


def average_models(blocks: DataFrame, model: LogBilinear, counts: Counts, text: str) -> LogBilinear:
    """Every block trains a copy; copies are summed in their task, then chunk by chunk, and averaged by tokens."""
    shared = blocks.sparkSession.sparkContext.broadcast((model, counts))  # VOCABULARY and DIM bound it

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, known = shared.value
        unigram, flat, weight = known.unigram(), None, 0.0
        for batch in batches:
            for block, payload in zip(batch.column("block").to_pylist(), batch.column("payload")):
                rows = unpack_table(payload.as_py())
                w = Words(text_bytes(rows.column(text)), lower=True)
                ids, contexts, _ = reader(known.words).tokens(w, w.hashes())
                learn = np.repeat(~np.array(rows.column("_held").to_pylist(), dtype=bool), w.counts + 1)
                if learn.any():
                    got = train_block(start, contexts[learn], ids[learn], unigram, SEED + block % 99991).flat().astype(np.float64)
                    flat = got * learn.sum() + (0 if flat is None else flat)
                    weight += float(learn.sum())
        if flat is not None:
            cut = np.array_split(flat, CHUNKS)
            yield pa.RecordBatch.from_pydict(
                {
                    "chunk": pa.array(range(CHUNKS), pa.int32()),
                    "salt": pa.array([TaskContext.get().partitionId() % 16] * CHUNKS, pa.int32()),
                    "weight": [weight] * CHUNKS,
                    "sums": pa.array([c.tobytes() for c in cut], pa.binary()),
                }
            )

    def add(pdf):
        total = sum(np.frombuffer(x, dtype=np.float64) for x in pdf["sums"])
        out = pdf.iloc[:1].copy()
        out["weight"], out["sums"] = pdf["weight"].sum(), [total.tobytes()]
        return out

    schema = "chunk int, salt int, weight double, sums binary"
    sums = blocks.select("block", "payload").mapInArrow(train, schema)
    total = sums.groupBy("chunk", "salt").applyInPandas(add, schema).groupBy("chunk").applyInPandas(add, schema)
    rows = sorted(total.collect(), key=lambda r: r["chunk"])  # CHUNKS rows: one model
    if not rows:
        return model
    return model.like(np.concatenate([np.frombuffer(r["sums"], dtype=np.float64) / r["weight"] for r in rows]))


_tables: dict[int, tuple] = {}


def scoring_tables(shared) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tables of the broadcast model, once per process."""
    model = shared.value[0]
    if id(model) not in _tables:
        _tables.clear()
        _tables[id(model)] = (model, model.normalised())
    return _tables[id(model)][1]


def score_texts(docs: DataFrame, held, text: str = "text") -> DataFrame:
    """``docs`` plus _held, n_tokens, n_known, train_tokens, base_score, score; learns from rows where ``held`` (a Column) is false."""
    spark = docs.sparkSession
    added = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    marked = docs.drop("_held", *added).withColumn("_held", F.coalesce(held, F.lit(False)))
    blocks = write_blocks(marked, text)
    n_shards = shards(blocks, SHARD_BYTES)
    asked = each_block(blocks, ask_counts(n_shards, text), "shard long, block long, blob binary, n long")
    answers = cut_lineage(
        by_shard(asked).mapInArrow(answer_counts, ANSWERS), "lm-counts"
    )
    totals = answers.filter(F.col("block") == -1)
    summed = totals.agg(F.sum("distinct"), F.sum("tokens")).first()
    ends = marked.filter(~F.col("_held")).count()
    top = most_frequent(totals, VOCABULARY - 2)
    counts = Counts(
        (summed[1] or 0) + ends, (summed[0] or 0) + (ends > 0), ends, tuple(bytes(r["word"]) for r in top), tuple(r["count"] for r in top)
    )
    model = LogBilinear.start(counts.unigram())
    for _ in range(ROUNDS):
        model = average_models(blocks, model, counts, text)
    shared = spark.sparkContext.broadcast((model, counts))  # VOCABULARY and DIM bound it

    def score(block: int, rows: pa.Table, replies: dict[int, bytes]) -> pa.Table:
        known = shared.value[1]
        one, two, norm = scoring_tables(shared)
        w, code, shard, first = own_words(text_bytes(rows.column(text)), n_shards)
        found = [np.frombuffer(expand(replies[s]), dtype="<i8") for s in sorted(replies)]
        c = np.concatenate(found)[code] if found else np.zeros(0, dtype=np.int64)
        base = np.log10((c + 1) / (known.tokens + known.distinct + 1))
        end = np.log10((known.ends + 1) / (known.tokens + known.distinct + 1))
        ids, contexts, place = reader(known.words).tokens(w, w.hashes())
        log_p = one[contexts[:, 0], ids] + two[contexts[:, 1], ids] - norm[contexts[:, 0], contexts[:, 1]]
        log_p = log_p.astype(np.float64) / np.log(10)
        unknown = ids[place] == UNKNOWN
        log_p[place[unknown]] += np.log10((c[unknown] + 1) / (known.unknown_tokens + known.unknown_distinct + 1))
        whole = np.repeat(np.arange(w.n_texts), w.counts + 1)
        n = w.n_texts
        return (
            rows.append_column("n_tokens", pa.array(w.counts + 1, pa.int64()))
            .append_column("n_known", pa.array(np.bincount(w.text[c > 0], minlength=n) + (known.ends > 0), pa.int64()))
            .append_column("train_tokens", pa.array(np.full(n, known.tokens), pa.int64()))
            .append_column("base_score", pa.array(np.bincount(w.text, weights=base, minlength=n) + end))
            .append_column("score", pa.array(np.bincount(whole, weights=log_p, minlength=n)))
        )

    kinds = (LongType(), LongType(), LongType(), DoubleType(), DoubleType())
    schema = StructType(marked.schema.fields + [StructField(a, k) for a, k in zip(added, kinds)])
    return each_answered(with_answers(blocks, answers.filter(F.col("block") >= 0)), score, schema)


def fold(key) -> F.Column:
    """crc32 of the id as text, modulo 7."""
    return F.crc32(key.cast("string").cast("binary")) % 7


def op8_lm_scoring(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = score_texts(docs, fold(F.col("doc_id")) == 2)
    return scored.select("doc_id", F.col("_held").alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
