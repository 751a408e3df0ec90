"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

Words (letters and digits, A-Z lowered) are hashed into 2 ** ``HASH_BITS``
buckets, and the buckets that training knows have an embedding each (so few
that rare words hardly ever share one; all others embed as zero);
filters of several widths slide over them, each keeps its maximum over the
whole text, and a logistic layer gives the score. Embeddings start at the
smoothed log-odds of their word on the training texts and are then trained
with filters and output by Adam; only the window that won a maximum gets its
gradient. Thresholds are calibrated for each language on a validation part.

Training sees every labelled text whole, of the rows the caller allows: one of
each group of copies and near copies, one in ``HELD`` of them for the
thresholds alone. Words are counted by Spark. The texts are dealt once to up to
``WORKERS`` workers and kept on the executors' disks; in a pass each worker goes
on from the shared model with its texts, and the mean of their models is the
next one, so the driver holds models, never texts.
Scoring reads whole texts. Labels, language, source and id are no
input of a score. Defined cases: a null or empty text gets the score of an
empty one; repeated rows are each scored; without labelled texts of both
classes every score is 0.5; an empty table gives no row.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..session import cut_lineage, drop_path, materialize, ship_package
from .blocks import BLOCK_BYTES, expand, grouped, pieces, squeeze, text_bytes
from .words import PUNCTUATED, Words, grams, mix

HASH_BITS = 44
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
UNKNOWN = 0  # row of the zero embedding; pads have it too
HELD = 6
WORKERS = 32
#: Texts of a worker at least, as long as there are fewer than ``WORKERS``.
TEXTS_PER_WORKER = 2000
#: Texts that a worker holds and mixes at a time.
MIXED = 256
#: So many labelled ids are broadcast at most.
BROADCAST_IDS = 4_000_000
MIN_TEXTS = 8
EPOCHS = 12
BATCH = 32
SEED = 11
CUT = 0.7


def buckets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets, each text as one pad (0), its words and two pads, and where each text begins (n + 1 bounds)."""
    w = Words(texts, lower=True, separators=PUNCTUATED)
    bounds = w.first + 3 * np.arange(w.n_texts + 1)
    out = np.zeros(bounds[-1], dtype=np.uint64)
    out[np.arange(len(w)) + 3 * w.text + 1] = (w.hashes() >> np.uint64(64 - HASH_BITS)) + np.uint64(1)
    return out, bounds


def rows_of(hashed: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Embedding row of each bucket: its place in the sorted ``known`` plus one, or UNKNOWN."""
    if not known.size:
        return np.zeros(hashed.size, dtype=np.int64)
    at = np.minimum(np.searchsorted(known, hashed), known.size - 1)
    return np.where(known[at] == hashed, at + 1, UNKNOWN)


@dataclass
class Model:
    known: np.ndarray  # sorted buckets that have an embedding
    embed: np.ndarray  # (1 + known) x DIM; row UNKNOWN is zero
    filters: dict[int, np.ndarray]  # width -> width x DIM x FILTERS
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    cuts: dict[str, float] = field(default_factory=dict)  # language -> calibrated threshold

    def tables(self) -> dict[int, list[np.ndarray]]:
        """What each word adds to each filter at each of its places."""
        return {k: [self.embed @ f[j] for j in range(k)] for k, f in self.filters.items()}

    def scores(self, texts: list[bytes], tables: dict[int, list[np.ndarray]]) -> np.ndarray:
        hashed, bounds = buckets(texts)
        ids = rows_of(hashed, self.known)
        pooled = []
        for k in WIDTHS:
            reply = tables[k][0][ids]
            for j in range(1, k):
                reply[:-j] += tables[k][j][ids[j:]]
            reply[bounds[1:] - 1] = -np.inf  # windows that begin in the closing pads reach the next text
            reply[bounds[1:] - 2] = -np.inf
            pooled.append(np.maximum.reduceat(reply, bounds[:-1], axis=0))
        z = np.concatenate(pooled, axis=1) + self.bias
        return 1 / (1 + np.exp(-(np.maximum(z, 0) @ self.out + self.out_bias).astype(np.float64)))


def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_h, slot, low): three pairs of minimum hashes of each text's five-word shingles; near copies share one."""
    for table in pieces(batches, "_text", BLOCK_BYTES):
        w = Words(text_bytes(table.column("_text")), lower=True, separators=PUNCTUATED)
        h, names, out = w.hashes(), table.column("_h").to_pylist(), []
        for i, name in enumerate(names):
            own = h[w.first[i] : w.first[i + 1]]
            shingles = grams(own, 5) if own.size >= 5 else own
            if shingles.size:
                lows = np.array([mix(shingles + np.uint64(seed * 0x9E37)).min() for seed in range(6)])
                out += [(name, j, low) for j, low in enumerate(mix(lows[::2] * np.uint64(31) + lows[1::2]).view(np.int64).tolist())]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64()))], names=["_h", "slot", "low"])


def distinct_texts(rows: DataFrame) -> DataFrame:
    """``rows`` (_h, _text, ...) with one text of each group of copies and near copies: they carry one label, not many.

    Of two texts that agree in a pair of minimum hashes the one with the smaller ``_h`` stays.
    """
    lows = cut_lineage(rows.select("_h", "_text").mapInArrow(signatures, "_h long, slot int, low long"), "toxic-signatures")
    first = lows.groupBy("slot", "low").agg(F.min("_h").alias("first"))
    later = cut_lineage(lows.join(first, ["slot", "low"]).filter("_h > first").select("_h").distinct(), "toxic-copies")
    return rows.join(later, "_h", "left_anti").dropDuplicates(["_h"])


def word_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, toxic, clean): texts of a block that hold each bucket."""
    for table in pieces(batches, "_text", BLOCK_BYTES):
        hashed, bounds = buckets(text_bytes(table.column("_text")))
        toxic = np.array(table.column("_toxic").to_pylist(), dtype=bool)
        names, code = np.unique(hashed, return_inverse=True)
        pairs = np.unique(np.repeat(np.arange(table.num_rows), np.diff(bounds)) * names.size + code)
        held = toxic[pairs // names.size]
        counts = [np.bincount(pairs[x] % names.size, minlength=names.size) for x in (held, ~held)]
        yield pa.RecordBatch.from_arrays([pa.array(names.astype(np.int64))] + [pa.array(c, pa.int64()) for c in counts], names=["bucket", "toxic", "clean"])


def known_words(used: DataFrame, n_toxic: int, n_clean: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted buckets worth an embedding, and the smoothed log-odds of the training texts they occur in.

    Buckets of fewer than ``MIN_TEXTS`` texts, or whose log-odds lie within
    three standard errors of 0, are left out: single texts with a wrong label
    must not teach the model their own vocabulary.
    """
    counts = used.mapInArrow(word_texts, "bucket long, toxic long, clean long").groupBy("bucket")
    counts = counts.agg((F.sum("toxic") + 0.5).alias("a"), (F.sum("clean") + 0.5).alias("b"))
    odds = F.log(F.col("a") / (n_toxic + 1)) - F.log(F.col("b") / (n_clean + 1))
    counts = counts.withColumn("odds", odds).filter((F.col("a") + F.col("b") >= MIN_TEXTS + 1) & (F.col("bucket") > 0))
    counts = counts.filter(F.abs("odds") >= 3 * F.sqrt(1 / F.col("a") + 1 / F.col("b")))
    got = counts.select("bucket", "odds").toArrow()  # sixteen bytes for each word that has an embedding
    names, odds = got.column("bucket").to_numpy().astype(np.uint64), got.column("odds").to_numpy()
    order = np.argsort(names)
    return names[order], odds[order]


def first_state(odds: np.ndarray) -> dict[str, np.ndarray]:
    """All that training changes: parameters, and what Adam and the embeddings' steps remember."""
    rng = np.random.default_rng(SEED)
    embed = rng.normal(0, 0.01, (odds.size + 1, DIM)).astype(np.float32)
    lead = rng.normal(0, 1, DIM)
    lead /= np.linalg.norm(lead)
    embed[1:] += ((0.5 * odds)[:, None] * lead).astype(np.float32)
    embed[UNKNOWN] = 0
    n_out = FILTERS * len(WIDTHS)
    state = {f"filter{k}": (rng.normal(0, 0.2, (k, DIM, FILTERS)) / k + 0.6 / k * lead[:, None]).astype(np.float32) for k in WIDTHS}
    state |= {"bias": np.zeros(n_out, np.float32), "out": np.full(n_out, 0.1, np.float32), "out_bias": np.array([-1.0], np.float32)}
    for name in list(state):
        state |= {f"{name}.m": np.zeros_like(state[name]), f"{name}.v": np.zeros_like(state[name])}
    return state | {"embed": embed, "grad_sq": np.full(odds.size + 1, 1e-4, np.float32), "t": np.zeros(1)}


def adam(state: dict[str, np.ndarray], name: str, g: np.ndarray, rate: float) -> None:
    m, v, t = state[f"{name}.m"], state[f"{name}.v"], state["t"][0]
    m += 0.1 * (g - m)
    v += 0.01 * (g * g - v)
    state[name] -= (rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)).astype(np.float32)


def train_batch(state: dict[str, np.ndarray], texts: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> None:
    """One step by the embedding rows and labels of a few texts."""
    state["t"] += 1
    own = np.concatenate(texts)
    sizes = np.array([t.size for t in texts])
    ends = np.cumsum(sizes)
    x = state["embed"][own]
    wins, pooled = {}, []
    for k in WIDTHS:
        f = state[f"filter{k}"]
        reply = x @ f[0]
        for j in range(1, k):
            reply[:-j] += x[j:] @ f[j]
        reply[ends - 1] = -np.inf
        reply[ends - 2] = -np.inf
        best = np.stack([reply[e - n : e].argmax(axis=0) + e - n for e, n in zip(ends, sizes)])
        wins[k] = best
        pooled.append(np.take_along_axis(reply, best, axis=0))
    z = np.concatenate(pooled, axis=1) + state["bias"]
    act = np.maximum(z, 0)
    p = 1 / (1 + np.exp(-(act @ state["out"] + state["out_bias"][0])))
    err = ((p - y) * weight / len(texts)).astype(np.float32)
    back = np.outer(err, state["out"]) * (z > 0)
    adam(state, "out", act.T @ err + 1e-4 * state["out"], 0.01)
    adam(state, "out_bias", np.array([err.sum()], np.float32), 0.02)
    adam(state, "bias", back.sum(axis=0), 0.01)
    touched, grads = [], []
    for n, k in enumerate(WIDTHS):
        g = back[:, n * FILTERS : (n + 1) * FILTERS]
        f = state[f"filter{k}"]
        gf = np.empty_like(f)
        for j in range(k):
            seen = x[wins[k] + j]  # texts x filters x DIM
            gf[j] = np.einsum("bfd,bf->df", seen, g)
            touched.append(own[wins[k] + j].ravel())
            grads.append((g[:, :, None] * f[j].T[None]).reshape(-1, DIM))
        adam(state, f"filter{k}", gf, 0.01)
    rows, place = np.unique(np.concatenate(touched), return_inverse=True)
    total = np.zeros((rows.size, DIM), np.float32)
    np.add.at(total, place, np.concatenate(grads))
    state["grad_sq"][rows] += (total * total).mean(axis=1)
    state["embed"][rows] -= 0.05 * total / np.sqrt(state["grad_sq"][rows])[:, None]
    state["embed"][UNKNOWN] = 0


def one_pass(shared, nth: int, share: float):
    """Each worker's state after its texts, and how many they are; ``share``: of toxic texts among all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for worker, rows in grouped(batches, "worker"):
            state, rng, n = pickle.loads(pickle.dumps(shared.value)), np.random.default_rng((SEED, nth, worker)), 0
            held = []

            def learn() -> None:
                order = rng.permutation(len(held))
                for at in range(0, len(order), BATCH):
                    pick = [held[i] for i in order[at : at + BATCH]]
                    y = np.array([t for t, _ in pick], dtype=np.float32)
                    train_batch(state, [ids for _, ids in pick], y, np.where(y > 0, 0.5 / share, 0.5 / (1 - share)))

            for row in rows:
                held.append((row["toxic"], np.frombuffer(expand(row["ids"]), "<i4")))
                n += 1
                if len(held) == MIXED:
                    learn()
                    held.clear()
            if held:
                learn()
            yield pa.RecordBatch.from_arrays([pa.array([worker], pa.int64()), pa.array([n], pa.int64()), pa.array([squeeze(pickle.dumps(state))], pa.binary())], names=["worker", "n", "state"])

    return run


def mean_state(states: DataFrame, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The mean of the workers' states (n, state), weighted by their texts; one of them is held at a time."""
    total, sums = 0, {k: np.zeros(v.shape) for k, v in like.items()}
    for r in states.toLocalIterator():  # WORKERS models at most; sums of doubles, so their order doesn't matter
        total += r["n"]
        for k, v in pickle.loads(expand(bytes(r["state"]))).items():
            sums[k] += v.astype(np.float64) * r["n"]
    return {k: (v / total).astype(like[k].dtype) for k, v in sums.items()}


def train(used: DataFrame, n_toxic: int, n_clean: int) -> Model:
    """The model of all rows of ``used`` (_h, _text, _toxic), in ``EPOCHS`` passes."""
    sc = used.sparkSession.sparkContext
    known, odds = known_words(used, n_toxic, n_clean)
    words = sc.broadcast(known)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in pieces(batches, "_text", BLOCK_BYTES):
            hashed, bounds = buckets(text_bytes(table.column("_text")))
            ids = rows_of(hashed, words.value).astype("<i4")
            blobs = [squeeze(ids[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [table.column("_h").combine_chunks(), pa.array(table.column("_toxic").to_pylist(), pa.int32()), pa.array(blobs, pa.binary())], names=["_h", "toxic", "ids"]
            )

    workers = min(WORKERS, max(1, (n_toxic + n_clean) // TEXTS_PER_WORKER))
    tokens = used.mapInArrow(numbered, "_h long, toxic int, ids binary").withColumn("worker", F.pmod(F.xxhash64("_h"), F.lit(workers)))
    tokens = cut_lineage(tokens, "toxic-tokens")
    # dealt and sorted once for all passes; a lost part is dealt again from the stored tokens, in the same order
    dealt = tokens.repartition(workers, "worker").sortWithinPartitions("worker", "_h").select("worker", "toxic", "ids")
    dealt = dealt.persist(StorageLevel.DISK_ONLY)
    state = first_state(odds)
    for nth in range(EPOCHS):
        shared = sc.broadcast(state)
        run = one_pass(shared, nth, n_toxic / (n_toxic + n_clean))
        states, path = materialize(dealt.mapInArrow(run, "worker long, n long, state binary"), "toxic-states")
        state = mean_state(states, state)
        drop_path(used.sparkSession, path)
        shared.unpersist()
    dealt.unpersist()
    return Model(known, state["embed"], {k: state[f"filter{k}"] for k in WIDTHS}, state["bias"], state["out"], float(state["out_bias"][0]))


def calibrated(model: Model, held: DataFrame) -> dict[str, float]:
    """For each language the threshold of best F1 on held texts (ties: nearest to CUT); CUT where there are too few."""
    scored = score(held.filter(F.col("_lang").isNotNull() & (F.col("_lang") != "")), model, text="_text", lang=None)
    grid, y = [float(g) for g in np.linspace(0.05, 0.95, 19)], F.col("_toxic") == 1
    over = [F.count(F.when(F.col("score") >= g, 1)).alias(f"all{i}") for i, g in enumerate(grid)]
    hits = [F.count(F.when(y & (F.col("score") >= g), 1)).alias(f"hit{i}") for i, g in enumerate(grid)]
    cuts = {}
    for r in scored.groupBy("_lang").agg(F.count(F.when(y, 1)).alias("toxic"), F.count(F.lit(1)).alias("n"), *over, *hits).collect():
        if r["toxic"] >= 5 and r["n"] - r["toxic"] >= 5:
            f1 = np.array([2 * r[f"hit{i}"] / max(1, r["toxic"] + r[f"all{i}"]) for i in range(len(grid))])
            cuts[r["_lang"]] = float(min(np.array(grid)[np.isclose(f1, f1.max())], key=lambda g: abs(g - CUT)))
    return cuts


def fit(docs: DataFrame, labels: DataFrame, allowed, text: str = "text", key: str = "doc_id", lang: str = "lang") -> Model | None:
    """Train on all labelled rows whose key passes ``allowed`` (a Column predicate)."""
    ship_package(docs.sparkSession)
    named = labels.select(F.col(key).alias("_k"), F.col("toxic").alias("_toxic"))
    named = cut_lineage(named.filter(F.col("_toxic").isin(0, 1) & F.coalesce(allowed(F.col("_k")), F.lit(False))), "toxic-labels")
    few = named.count() <= BROADCAST_IDS
    rows = docs.select(F.col(key).alias("_k"), F.col(text).alias("_text"), F.col(lang).alias("_lang")).filter(F.col("_text").isNotNull())
    rows = rows.join(F.broadcast(named) if few else named, "_k").select(F.xxhash64("_k", "_text").alias("_h"), "_text", "_lang", "_toxic")
    rows = cut_lineage(distinct_texts(rows), "toxic-texts")
    held = F.pmod(F.xxhash64(F.lit(SEED), "_h"), F.lit(HELD)) == 0
    used = rows.filter(~held)
    counts = {r["_toxic"]: r["count"] for r in used.groupBy("_toxic").count().collect()}
    if not counts.get(0) or not counts.get(1):
        return None
    model = train(used, counts[1], counts[0])
    model.cuts = calibrated(model, rows.filter(held))
    return model


def score(docs: DataFrame, model: Model | None, text: str = "text", lang: str | None = "lang") -> DataFrame:
    """``docs`` plus ``score`` and, where ``lang`` names a column, ``flagged`` by that language's threshold.

    A clashing ``score`` or ``flagged`` column is replaced.
    """
    docs = docs.drop("score", "flagged")
    cuts = model.cuts if model else {}
    if model is None:
        scored = docs.withColumn("score", F.lit(0.5))
    else:
        ship_package(docs.sparkSession)
        shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the words that have an embedding
        schema = StructType(docs.schema.fields + [StructField("score", DoubleType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = shared.value
            tables = own.tables()
            for table in pieces(batches, text, 1 << 20):
                got = own.scores(text_bytes(table.column(text)), tables)
                yield from table.append_column("score", pa.array(got)).to_batches()

        scored = docs.mapInArrow(run, schema)
    if lang is None:
        return scored
    cut = F.lit(CUT)
    for name, value in sorted(cuts.items()):
        cut = F.when(F.col(lang) == name, F.lit(value)).otherwise(cut)
    return scored.withColumn("flagged", F.col("score") >= cut)


def fold(key) -> F.Column:
    """crc32 of the id as text, modulo 3; a null id is in no fold."""
    return F.crc32(key.cast("string").cast("binary")) % 3


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted, flagged."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(docs, labels, lambda k: fold(k) != 1)
    return score(docs, model).select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
        "flagged",
    )
