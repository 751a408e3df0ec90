"""Power-of-two packing: documents cut into pieces of binary lengths, equal lengths bucketed together.

A document's ids (its tokens and one end id) are cut into as many pieces of
``capacity`` as fit and then, for the rest, one piece for each set bit of its
length, largest first. Every piece is a sequence of its own whose length is a
power of two, so no sequence crosses documents and none is padded; sequences
of one length form a bucket.

Defined cases: a null or empty text gives the end id alone; every row is a
document of its own, also where ids repeat or are null; carried columns pass
through unchanged; an empty table gives no piece. One scan, no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from ..session import ship_package

CAPACITY = 1024
END_ID = 0
SPECIAL = "<|endoftext|>"


@lru_cache(maxsize=4)
def _encoders(ranks_file: str, json_file: str):
    """A fast encoder and the reference encoder of one vocabulary, once per process."""
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    whole = Tokenizer.from_file(json_file)
    special = {SPECIAL: whole.token_to_id(SPECIAL)}
    fast = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return fast, whole


def token_ids(text: str | None, ranks_file: str, json_file: str) -> np.ndarray:
    """Ids of a text as the vocabulary's own tokenizer gives them (special strings included), without an end id."""
    if not text:
        return np.zeros(0, dtype=np.uint32)
    fast, whole = _encoders(ranks_file, json_file)
    if SPECIAL in text:
        return np.array(fast.encode(text, allowed_special={SPECIAL}), dtype=np.uint32)
    return fast.encode_to_numpy(text, disallowed_special=()).astype(np.uint32, copy=False)


def binary_lengths(n: int, capacity: int) -> list[int]:
    """Piece lengths of n ids: full pieces, then the set bits of the rest from the largest."""
    rest = n % capacity
    return [capacity] * (n // capacity) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(
    docs: DataFrame,
    ranks_file: str,
    json_file: str,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """``keep`` columns plus start, length, doc_tokens, ids (little-endian unsigned 32-bit), sequence_id, offset, bucket.

    ``bucket`` is the base-2 logarithm of the length and leads ``sequence_id``.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    ship_package(docs.sparkSession)
    source = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col(text).alias("_text"))
    keys = [f.name for f in source.schema.fields[:-1]]
    numbers = ("start", "length", "doc_tokens")
    schema = StructType(
        source.schema.fields[:-1] + [StructField(c, LongType()) for c in numbers] + [StructField("ids", BinaryType())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text")
            for at in range(0, batch.num_rows, 256):
                part = range(at, min(at + 256, batch.num_rows))
                rows, starts, lengths, totals, ids = [], [], [], [], []
                for i in part:
                    own = np.append(token_ids(texts[i].as_py(), ranks_file, json_file), np.uint32(end_id)).astype("<u4")
                    data, start = own.tobytes(), 0
                    for n in binary_lengths(own.size, capacity):
                        rows.append(i)
                        starts.append(start)
                        lengths.append(n)
                        totals.append(own.size)
                        ids.append(data[4 * start : 4 * (start + n)])
                        start += n
                taken = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).take(taken) for k in keys]
                    + [pa.array(v, pa.int64()) for v in (starts, lengths, totals)]
                    + [pa.array(ids, pa.binary())],
                    names=[*keys, *numbers, "ids"],
                )

    pieces = source.mapInArrow(cut, schema)
    bucket = F.round(F.log2(F.col("length"))).cast("int")
    return pieces.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)],
        *numbers,
        "ids",
        (F.shiftleft(bucket.cast("long"), 57) + F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        bucket.alias("bucket"),
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Store packed sequences with one folder for each length, so a batch reads sequences of one shape."""
    pieces.write.partitionBy("bucket").parquet(path)


def vocabulary_files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")


def op7_packing(spark, sf_dir: str) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket: one row per piece."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(docs, *vocabulary_files()).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket"
    )
