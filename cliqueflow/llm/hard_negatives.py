"""Hard negatives by Kronecker-packed products: several candidates' components in one wide integer.

Components are biased to be non-negative and put side by side in fields of one
wide integer, each field wide enough for a whole inner product. One product
with an anchor's component then serves all candidates of the integer; the sums
are unpacked and the bias is taken off again, so every score is exact. Wide
integers are held in doubles while they stay below 2^53, where a matrix
product is exact, and in Python integers of any width beyond.

The anchors, in blocks, meet all rows, in blocks, twice: first for their best
rows of the same label (the positives), then for the best rows of another
label whose score lies within the given shares of a positive's score. Every
meeting sends on only its own best rows.

Defined cases: rows with a null id, label or vector, or a null or non-finite
component, take no part; shorter vectors count as padded with zeros; a row
with the anchor's id is no candidate; each repeated anchor row gets its own
answer, repeated candidates are candidates of their own; ties go to the
smaller id; scores beyond a long are clipped; an anchor without positives, a
positive without negatives and an empty table give no row. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, ship_package
from .blocks import expand, squeeze
from .topk import usable

#: Candidates of a block, anchors of a block, and anchors whose scores are held at a time.
CANDIDATES = 8192
ANCHORS = 512
AT_ONCE = 64
#: Whole numbers below 2^53 are exact in a double.
DOUBLE_BITS = 53
#: Fields of a Python integer.
FIELDS = 8
LONG = (-(1 << 63), (1 << 63) - 1)


def wide_products(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products (anchors x candidates) as long integers, clipped; both int64 of one width."""
    (m, dim), n = anchors.shape, candidates.shape[0]
    if not (m and n and dim):
        return np.zeros((m, n), dtype=np.int64)
    low_a, low_c = int(anchors.min()), int(candidates.min())
    top_a, top_c = int(anchors.max()) - low_a, int(candidates.max()) - low_c
    width = max(1, (top_a * top_c * dim).bit_length())
    # what the bias adds to a sum must fit a long as well
    reach = (top_a + abs(low_a)) * (top_c + abs(low_c)) * dim
    fields, kind = (DOUBLE_BITS // width, np.float64) if width <= DOUBLE_BITS and reach < 1 << 60 else (FIELDS, object)
    whole = np.int64 if kind is np.float64 else object
    a, c = anchors.astype(whole) - low_a, candidates.astype(whole) - low_c
    rows = -(-n // fields)
    wide = np.zeros((rows, dim), dtype=kind)
    for f in range(fields):
        part = c[f * rows : (f + 1) * rows]
        wide[: part.shape[0]] += part.astype(kind) * (1 << (width * f))
    sums = (a.astype(kind) @ wide.T).astype(whole)
    mask = (1 << width) - 1
    unpacked = np.concatenate([(sums >> (width * f)) & mask for f in range(fields)], axis=1)[:, :n]
    scores = unpacked + low_c * a.sum(axis=1)[:, None] + low_a * c.sum(axis=1)[None, :] + dim * low_a * low_c
    return scores if whole is np.int64 else np.clip(scores, *LONG).astype(np.int64)


def first_rows(scores: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """The k best of ``places`` (ascending ids): highest score first, ties in their order."""
    own = scores[places]
    if places.size > k:
        least = np.partition(own, places.size - k)[places.size - k]
        above = np.flatnonzero(own > least)
        chosen = np.concatenate((above, np.flatnonzero(own == least)[: k - above.size]))
        places, own = places[chosen], own[chosen]
    # ~score falls as the score rises, without the overflow of a minus sign
    return places[np.lexsort((places, ~own))]


class Block:
    """Ids (ascending), labels and vectors of some rows."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> Block:
        rows = batch.column("ints").to_pylist()
        vectors = np.zeros((len(rows), max(map(len, rows), default=0)), dtype=np.int64)
        for i, r in enumerate(rows):
            vectors[i, : len(r)] = r
        return cls(batch.column("id").to_numpy(), batch.column("label").to_numpy(), vectors)

    def packed(self) -> bytes:
        head = np.array(self.vectors.shape, dtype="<i8")
        return squeeze(b"".join(x.astype("<i8").tobytes() for x in (head, self.ids, self.labels, self.vectors)))

    @classmethod
    def unpacked(cls, payload: bytes) -> Block:
        data = np.frombuffer(expand(payload), dtype="<i8")
        n, dim = data[:2]
        return cls(data[2 : 2 + n], data[2 + n : 2 + 2 * n], data[2 + 2 * n :].reshape(n, dim))

    def widened(self, dim: int) -> np.ndarray:
        return np.pad(self.vectors, ((0, 0), (0, dim - self.vectors.shape[1])))

    def scores(self, others: Block) -> Iterator[tuple[int, np.ndarray]]:
        """Every row's number and its products with all rows of ``others``."""
        dim = max(self.vectors.shape[1], others.vectors.shape[1])
        mine, theirs = self.widened(dim), others.widened(dim)
        for at in range(0, self.ids.size, AT_ONCE):
            for i, row in enumerate(wide_products(mine[at : at + AT_ONCE], theirs), at):
                yield i, row


def scaled(df: DataFrame, key: str, vector: str, label: Column, scale: int) -> DataFrame:
    """id, label, ints (floor of scale * component) of the rows that take part."""
    v = F.col("v")
    ints = F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x).cast("long"))
    rows = df.select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v"))
    return rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(v)).select("id", "label", ints.alias("ints"))


def write_blocks(rows: DataFrame, size: int, tag: str) -> tuple[DataFrame, int]:
    """Stored blocks (part, block, payload) of at most ``size`` rows, dealt evenly; and the number of parts."""
    parts = max(1, -(-rows.count() // size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                yield pa.RecordBatch.from_pydict(
                    {"part": pa.array([part.column("part")[0].as_py()], pa.int32()), "payload": pa.array([Block.of(part).packed()], pa.binary())}
                )

    dealt = rows.repartition(parts).withColumn("part", F.spark_partition_id())
    blocks = dealt.mapInArrow(run, "part int, payload binary").withColumn("block", F.monotonically_increasing_id())
    return cut_lineage(blocks, tag), parts


def _meet(pairs: DataFrame, schema: str, find) -> DataFrame:
    """Rows ``find(block number, anchors, goals, candidates)`` of every pair of blocks (block, q, goals, c)."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, goals = batch.column("block")[i].as_py(), batch.column("goals")[i].as_py() or []
                anchors, others = (Block.unpacked(batch.column(c)[i].as_py()) for c in ("q", "c"))
                found = list(find(block, anchors, goals, others))
                if found:
                    columns = [pa.array(c, pa.int64()) for c in zip(*found)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return pairs.select("block", "q", "goals", "c").mapInArrow(run, schema)


def mine(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5, least: int = 80, most: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score (all but rank long).

    ``rows`` and ``anchors`` are of ``scaled``. For each anchor and each of its
    ``positives`` best rows of the same label: the ``negatives`` best rows of
    another label whose score is within ``least`` and ``most`` percent of the
    positive's.
    """
    ship_package(rows.sparkSession)
    stored, parts = write_blocks(rows, CANDIDATES, "candidates")
    asked, _ = write_blocks(anchors, ANCHORS, "anchors")
    c = stored.select("part", F.col("payload").alias("c"))
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    none = F.lit(None).cast("array<struct<row:bigint,id:bigint,score:bigint,place:int>>")
    q = asked.select("block", F.col("payload").alias("q"))

    def same_label(block, own, _, others):
        for i, scores in own.scores(others):
            places = np.flatnonzero((others.labels == own.labels[i]) & (others.ids != own.ids[i]))
            for p in first_rows(scores, places, positives):
                yield block, i, others.ids[p], scores[p]

    first = _meet(q.withColumn("goals", none).withColumn("part", everywhere).join(c, "part"), "block long, row long, id long, score long", same_label)
    order = Window.partitionBy("block", "row").orderBy(F.desc("score"), F.asc("id"))
    best = first.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= positives)
    goals = cut_lineage(best.groupBy("block").agg(F.collect_list(F.struct("row", "id", "score", "place")).alias("goals")), "positives")

    def other_label(block, own, goals, others):
        wanted: dict[int, list] = {}
        for g in goals:
            wanted.setdefault(g["row"], []).append(g)
        for i, scores in own.scores(others):
            if i not in wanted:
                continue
            other = np.flatnonzero((others.labels != own.labels[i]) & (others.ids != own.ids[i]))
            for g in wanted[i]:
                # the least and the highest whole score within the shares
                low, high = -(-least * g["score"] // 100), most * g["score"] // 100
                near = other[(scores[other] >= max(low, LONG[0])) & (scores[other] <= min(high, LONG[1]))]
                for p in first_rows(scores, near, negatives):
                    yield block, i, g["place"], own.ids[i], g["id"], g["score"], others.ids[p], scores[p]

    asked_again = q.join(goals, "block").withColumn("part", everywhere)
    schema = "block long, row long, place long, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    found = _meet(asked_again.join(c, "part"), schema, other_label)
    order = Window.partitionBy("block", "row", "place").orderBy(F.desc("negative_score"), F.asc("negative_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Five negatives for each of the five positives of every vector whose id is divisible by 100.

    Every seventh label is moved on by one, so some labels are wrong.
    """
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = scaled(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding", moved, 256)
    return mine(rows, rows.filter(F.col("id") % 100 == 0))
