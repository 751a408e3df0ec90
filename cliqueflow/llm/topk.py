"""Exact top-k by inner product: candidates bucketed by length, pruned by local cosine thresholds.

Vectors are range-partitioned by their Euclidean length and stored in buckets
of at most ``BUCKET`` vectors of similar length. The longest bucket gives every
query a first bound (its k-th best score there). In any other bucket a vector
can only beat that bound if its cosine with the query reaches
bound / (query length * longest length in the bucket): above 1 the bucket is
skipped; a high threshold prunes by the query's strongest coordinate, a low
one by length. What is left is verified with exact integer products.

Defined cases: rows with a null id, a null vector, or a null or non-finite
component take no part; a row is no candidate of a query with its id; shorter
vectors count as padded with zeros; each repeated query row gets its own
answer; scores beyond a long are clipped; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package
from .blocks import expand, squeeze

BUCKET = 2048
QUERIES = 256
#: Cosine thresholds from here on prune by coordinate, lower ones by length.
BY_COORDINATE = 0.3
SLACK = 1e-9


def pack(ids: np.ndarray, vectors: np.ndarray, bounds: np.ndarray) -> bytes:
    head = np.array([vectors.shape[0], vectors.shape[1]], dtype="<i8").tobytes()
    return squeeze(head + ids.astype("<i8").tobytes() + vectors.astype("<i8").tobytes() + bounds.astype("<f8").tobytes())


def unpack(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = expand(payload)
    n, dim = np.frombuffer(data, dtype="<i8", count=2)
    ids = np.frombuffer(data, dtype="<i8", count=n, offset=16)
    vectors = np.frombuffer(data, dtype="<i8", count=n * dim, offset=16 + 8 * n).reshape(n, dim)
    return ids, vectors, np.frombuffer(data, dtype="<f8", count=n, offset=16 + 8 * n * (1 + dim))


def matrix(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    out = np.zeros((len(rows), max(map(len, rows), default=0)), dtype=np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products as int64 (clipped); vectors and query of one width."""
    peak = float(np.abs(vectors.astype(np.float64)).max(initial=0)) * float(np.abs(query.astype(np.float64)).max(initial=0))
    if peak * max(1, query.size) < 2.0**53:
        return (vectors.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    exact = vectors.astype(object) @ query.astype(object)
    return np.array([max(-(1 << 63), min((1 << 63) - 1, int(x))) for x in exact], dtype=np.int64)


def widened(vectors: np.ndarray, dim: int) -> np.ndarray:
    return np.pad(vectors, ((0, 0), (0, dim - vectors.shape[1]))) if vectors.shape[1] < dim else vectors


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: highest score, then smallest id."""
    return np.lexsort((ids, -scores.astype(np.float64) if abs(scores).max(initial=0) < 2**53 else [-int(s) for s in scores]))[:k]


class Bucket:
    """Candidates of one bucket, longest first."""

    def __init__(self, payload: bytes):
        self.ids, self.vectors, self.lengths = unpack(payload)
        self.units = self.vectors / np.maximum(self.lengths, 1e-300)[:, None]

    def search(self, query_id: int, query: np.ndarray, length: float, bound: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best candidates whose score can reach ``bound``."""
        places = self.survivors(query, length, bound)
        places = places[self.ids[places] != query_id]
        dim = max(query.size, self.vectors.shape[1])
        wide = np.pad(query, (0, dim - query.size))
        scores = products(widened(self.vectors[places], dim), wide)
        places, scores = places[scores >= bound], scores[scores >= bound]
        top = best(self.ids[places], scores, k)
        return self.ids[places[top]], scores[top]

    def survivors(self, query: np.ndarray, length: float, bound: float) -> np.ndarray:
        if bound <= 0 or not self.lengths.size:
            return np.arange(self.ids.size)
        reach = length * self.lengths[0]
        cosine = bound / reach * (1 - SLACK) if reach else 2.0
        if cosine > 1:
            return np.zeros(0, dtype=np.int64)
        if cosine < BY_COORDINATE:
            return np.arange(np.searchsorted(-self.lengths, -bound / length * (1 - SLACK), side="right"))
        strongest = int(np.abs(query[: self.vectors.shape[1]]).argmax()) if self.vectors.shape[1] and query.size else 0
        q = query[strongest] / length
        spread = np.sqrt(max(0.0, 1 - q * q) * (1 - cosine * cosine)) + SLACK
        low = q * cosine - spread if q > -cosine else -1.0
        high = q * cosine + spread if q < cosine else 1.0
        at = self.units[:, strongest]
        return np.flatnonzero((at >= low) & (at <= high + SLACK))


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def scaled(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """id, ints (floor of scale * component) and their Euclidean length."""
    v = F.col("_v")
    ints = F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x).cast("long"))
    square = F.aggregate(F.col("ints"), F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return (
        df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("_v"))
        .filter(F.col("id").isNotNull() & usable(v))
        .select("id", ints.alias("ints"))
        .withColumn("length", F.sqrt(square))
    )


def write_buckets(vectors: DataFrame) -> tuple[DataFrame, int]:
    """Buckets (part, longest, shortest, size, payload) by length, stored; and the number of parts."""
    spark = vectors.sparkSession
    parts = max(1, -(-vectors.count() // (4 * BUCKET)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BUCKET):
                part = batch.slice(at, BUCKET)
                lengths = part.column("length").to_numpy()
                payload = pack(part.column("id").to_numpy(), matrix(part.column("ints")), lengths)
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array([part.column("part")[0].as_py()], pa.int32()),
                        "longest": [float(lengths[0])],
                        "shortest": [float(lengths[-1])],
                        "size": pa.array([part.num_rows], pa.int64()),
                        "payload": pa.array([payload], pa.binary()),
                    }
                )

    path = scratch_path(spark, "topk")
    ranged = vectors.repartitionByRange(parts, F.desc("length"), F.asc("id")).sortWithinPartitions(F.desc("length"), F.asc("id"))
    ranged.withColumn("part", F.spark_partition_id() % parts).mapInArrow(
        run, "part int, longest double, shortest double, size long, payload binary"
    ).write.parquet(path)
    return spark.read.parquet(path), parts


def query_blocks(queries: DataFrame) -> DataFrame:
    """Queries packed by up to QUERIES rows: qblock, payload."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, QUERIES):
                part = batch.slice(at, QUERIES)
                payload = pack(part.column("id").to_numpy(), matrix(part.column("ints")), part.column("length").to_numpy())
                yield pa.RecordBatch.from_pydict({"payload": pa.array([payload], pa.binary())})

    path = scratch_path(queries.sparkSession, "topk-queries")
    queries.mapInArrow(run, "payload binary").withColumn("qblock", F.monotonically_increasing_id()).write.parquet(path)
    return queries.sparkSession.read.parquet(path)


HITS = "qblock long, qrow int, query_id long, vec_id long, score long"


def search_pairs(pairs: DataFrame, k: int) -> DataFrame:
    """Local top k of every (query block, bucket) pair: columns qblock, q, bounds (null: none), c."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                qblock = batch.column("qblock")[i].as_py()
                ids, vectors, lengths = unpack(batch.column("q")[i].as_py())
                bounds = batch.column("bounds")[i].as_py() or {}
                bounds = {b["qrow"]: b["bound"] for b in bounds}
                bucket = Bucket(batch.column("c")[i].as_py())
                out = {f.split()[0]: [] for f in HITS.split(", ")}
                for row in range(ids.size):
                    got, scores = bucket.search(int(ids[row]), vectors[row], float(lengths[row]), bounds.get(row, -np.inf), k)
                    out["qblock"] += [qblock] * got.size
                    out["qrow"] += [row] * got.size
                    out["query_id"] += [int(ids[row])] * got.size
                    out["vec_id"] += got.tolist()
                    out["score"] += scores.tolist()
                yield pa.RecordBatch.from_pydict(out, pa.schema([(n, pa.int32() if n == "qrow" else pa.int64()) for n in out]))

    return pairs.select("qblock", "q", "bounds", "c").mapInArrow(run, HITS)


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score of every query row's k best among ``vectors`` (both from ``scaled``)."""
    ship_package(vectors.sparkSession)
    buckets, parts = write_buckets(vectors)
    asked = query_blocks(queries)
    none = F.lit(None).cast("array<struct<qrow:int,bound:double>>")
    c = buckets.select("part", "longest", F.col("payload").alias("c"))
    q = asked.select("qblock", F.col("payload").alias("q"))
    # one bucket, the longest that can hold k candidates besides the query: its k-th score bounds every query
    first = buckets.filter(F.col("size") > k).orderBy(F.desc("longest"), F.desc("size")).limit(1)
    seeds = first.select(F.lit(0).alias("one"), F.col("payload").alias("c"))
    hits = search_pairs(q.withColumn("one", F.lit(0)).withColumn("bounds", none).join(F.broadcast(seeds), "one"), k)
    bounds = (
        hits.groupBy("qblock", "qrow")
        .agg(F.when(F.count(F.lit(1)) >= k, F.min("score").cast("double")).alias("bound"))
        .filter(F.col("bound").isNotNull())
        .groupBy("qblock")
        .agg(F.collect_list(F.struct("qrow", "bound")).alias("bounds"))  # at most QUERIES
    )
    # the stated query set meets every part of the table, block by block
    everywhere = q.join(bounds, "qblock", "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    found = search_pairs(everywhere.join(c, "part"), k)
    order = Window.partitionBy("qblock", "qrow", "query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op9_topk(spark, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: ten best of every vector whose id is divisible by 100."""
    vectors = scaled(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding", 1024)
    return top_k(vectors, vectors.filter(F.col("id") % 100 == 0), 10)
