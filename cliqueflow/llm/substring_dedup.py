"""Substring dedup over word windows by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one text. Its minimiser is the
smallest hash of the ``MINIMISER`` consecutive words inside it; neighbouring
windows mostly share one, and such a run travels as one packed string of words
to the bucket of its minimiser. Equal windows have equal minimisers, so they
meet in one bucket, which sorts its windows and compares them byte for byte.

Blocks of documents send each different string once, with the smallest id that
has it; a bucket answers which windows of a string start in a document with a
smaller id still. So the rows that one passage costs grow with the blocks that
hold it, not with its copies. A bucket that holds more than ``BUCKET_LIMIT``
bytes (a minimiser with very many contexts) is not gathered: its rows go on as
single windows, which are aggregated and joined by their own text.

Defined cases: a null or empty text has no word; rows that share an id do not
remove each other's words; a row with a null id comes after every other and
removes nothing elsewhere; other columns pass through unchanged (the new names
replace clashing ones); an empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..session import cut_lineage
from .blocks import arrow_of, by_shard, each_answered, each_block, expand, grouped, shards, squeeze, text_bytes, with_answers, write_blocks
from .words import Words, equal_spans, grams, mix

WINDOW = 13
MINIMISER = 3
#: Windows of one packed string at most; repetitive texts would make endless ones.
RUN = 48
#: Packed block bytes whose strings share a bucket, and the bytes that one task gathers for a bucket at most.
SHARD_BYTES = 1 << 20
BUCKET_LIMIT = 64 << 20
LAST = np.iinfo(np.int64).max
#: Columns of the result besides those of the documents.
ADDED = ("n_words", "n_removed", "kept", "kept_sha256")


class Strings:
    """The super-k-mers of a block: runs of windows, their distinct strings, and the order they are sent in."""

    def __init__(self, texts: list[bytes], ids: np.ndarray, window: int, n_buckets: int):
        self.words = w = Words(texts)
        self.window = window
        h = w.hashes()
        inner = grams(h, MINIMISER)
        n = len(w) - window + 1
        if n <= 0:
            self.starts = self.sizes = self.entry = self.doc = np.zeros(0, dtype=np.int64)
            self.bounds, self.buckets, self.lengths, self.least, self.strings = np.zeros(1, np.int64), [], np.zeros(0, np.int64), np.zeros(0, np.int64), []
            return
        low = inner[:n].copy()
        for j in range(1, window - MINIMISER + 1):
            np.minimum(low, inner[j : j + n], out=low)
        whole = w.text[:n] == w.text[window - 1 :]
        new = np.ones(n, dtype=bool)
        new[1:] = (low[1:] != low[:-1]) | ~whole[:-1] | (w.text[1:n] != w.text[: n - 1])
        begin = np.flatnonzero(new & whole)
        stop = np.flatnonzero(np.concatenate((new[1:] | ~whole[1:], [True])) & whole) + 1
        # long runs in steps of RUN windows
        extra = (stop - begin - 1) // RUN
        step = np.arange(extra.sum() + begin.size) - np.repeat(np.cumsum(extra + 1) - extra - 1, extra + 1)
        self.starts = np.repeat(begin, extra + 1) + RUN * step
        self.sizes = np.minimum(np.repeat(stop, extra + 1) - self.starts, RUN)
        self.doc = w.text[self.starts]
        spaced, _ = w.joined()
        width = np.concatenate(([0], np.cumsum(w.ends - w.starts + 1)))
        a, b = width[self.starts], width[self.starts + self.sizes + window - 1] - 1
        data = spaced.tobytes()
        numbers: dict[bytes, int] = {}
        entry = np.fromiter((numbers.setdefault(data[x:y], len(numbers)) for x, y in zip(a.tolist(), b.tolist())), np.int64, a.size)
        first = np.unique(entry, return_index=True)[1]
        bucket = (mix(low[self.starts[first]]) % np.uint64(n_buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(order.size)
        self.entry = place[entry]  # of every run, in the order of sending
        strings = list(numbers)
        self.strings = [strings[i] for i in order]
        self.lengths = self.sizes[first][order]  # windows of every entry
        self.least = np.full(order.size, LAST)
        np.minimum.at(self.least, self.entry, ids[self.doc])
        bucket = bucket[order]
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        self.bounds = np.concatenate(([0], cuts, [bucket.size]))
        self.buckets = bucket[self.bounds[:-1]].tolist()


def pack_strings(least: np.ndarray, strings: list[bytes]) -> bytes:
    return squeeze(np.int64(least.size).tobytes() + least.astype("<i8").tobytes() + b"\n".join(strings))


def unpack_strings(blob: bytes) -> tuple[np.ndarray, list[bytes]]:
    data = expand(blob)
    n = int(np.frombuffer(data, dtype="<i8", count=1)[0])
    return np.frombuffer(data, dtype="<i8", count=n, offset=8), data[8 + 8 * n :].split(b"\n")


def ids_of(column: pa.ChunkedArray) -> np.ndarray:
    return np.array([LAST if x is None else x for x in column.to_pylist()], dtype=np.int64)


def ask(text: str, key: str, window: int, n_buckets: int) -> Callable[[int, pa.Table], Iterator[dict]]:
    def run(block: int, rows: pa.Table) -> Iterator[dict]:
        s = Strings(text_bytes(rows.column(text)), ids_of(rows.column(key)), window, n_buckets)
        for i, bucket in enumerate(s.buckets):
            a, b = s.bounds[i], s.bounds[i + 1]
            yield {"shard": bucket, "block": block, "blob": pack_strings(s.least[a:b], s.strings[a:b])}

    return run


class Windows:
    """All windows of a list of strings: their words' places, entry by entry."""

    def __init__(self, strings: list[bytes], window: int):
        self.words = w = Words(strings)
        per = np.maximum(w.counts - window + 1, 0)
        self.entry = np.repeat(np.arange(len(strings)), per)
        self.first = np.concatenate(([0], np.cumsum(per)))  # windows of entry i: first[i]..first[i+1]
        self.at = np.arange(self.first[-1]) - np.repeat(self.first[:-1], per) + np.repeat(w.first[:-1], per)
        self.window = window

    def groups(self) -> np.ndarray:
        """A number for every window, equal exactly where the words are."""
        w, at, last = self.words, self.at, self.at + self.window - 1
        if not at.size:
            return at
        hashed = grams(w.hashes(), self.window)[at]
        order = np.argsort(hashed, kind="stable")
        same = np.zeros(at.size, dtype=bool)
        same[1:] = hashed[order[1:]] == hashed[order[:-1]]
        pairs = np.flatnonzero(same)
        view = w.loads()
        here, before = order[pairs], order[pairs - 1]
        equal = equal_spans(view, w.starts[at[here]], w.ends[last[here]], w.starts[at[before]], w.ends[last[before]])
        out = np.empty(at.size, dtype=np.int64)
        out[order] = np.cumsum(~same)
        if not equal.all():  # two different windows with one hash: tell those by their bytes
            names: dict[tuple[int, bytes], int] = {}
            for i in np.flatnonzero(np.isin(out, out[here[~equal]])):
                text = w.buf[w.starts[at[i]] : w.ends[last[i]]].tobytes()
                out[i] = names.setdefault((int(out[i]), text), at.size + len(names))
        return out


REPLIES = "block long, shard long, reply binary, blob binary"


def answer(window: int, limit: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Replies of a bucket: for each question the places of windows that a smaller id has.

    The rows of a bucket beyond ``limit`` bytes come back unanswered (with their blob).
    """
    schema = arrow_of(REPLIES)

    def rows_out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in grouped(batches, "shard"):
            held, size, over = [], 0, False
            for row in rows:
                size += zstd_size(row["blob"])
                over = over or size > limit
                held.append((row["block"], row["blob"]))
                if over:
                    yield rows_out([(b, bucket, None, blob) for b, blob in held])
                    held = []
            if not held:
                continue
            least, strings, spans = [], [], [0]
            for _, blob in held:
                own_least, own = unpack_strings(blob)
                least.append(own_least)
                strings += own
                spans.append(len(strings))
            all_least = np.concatenate(least)
            win = Windows(strings, window)
            group = win.groups()
            _, group = np.unique(group, return_inverse=True)
            low = np.full(group.max(initial=-1) + 1, LAST)
            np.minimum.at(low, group, all_least[win.entry])
            later = low[group] < all_least[win.entry]
            out = []
            for i, (block, _) in enumerate(held):
                a, b = win.first[spans[i]], win.first[spans[i + 1]]
                places = np.flatnonzero(later[a:b])
                if places.size:
                    out.append((block, bucket, squeeze(places.astype("<u4").tobytes()), None))
            if out:
                yield rows_out(out)

    return run


def zstd_size(blob: bytes) -> int:
    import zstandard

    return zstandard.frame_content_size(blob)


SINGLE = "block long, shard long, place long, least long, words binary"


def single_windows(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Every window of unanswered rows, by itself."""
    schema = arrow_of(SINGLE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                least, strings = unpack_strings(row["blob"])
                win = Windows(strings, window)
                w = win.words
                for a in range(0, win.at.size, 20_000):
                    part = slice(a, min(a + 20_000, win.at.size))
                    words = [w.buf[w.starts[x] : w.ends[x + window - 1]].tobytes() for x in win.at[part]]
                    n = len(words)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row["block"]] * n, pa.int64()),
                            pa.array([row["shard"]] * n, pa.int64()),
                            pa.array(np.arange(part.start, part.stop)),
                            pa.array(least[win.entry[part]]),
                            pa.array(words, pa.binary()),
                        ],
                        schema=schema,
                    )

    return run


def answer_singles(unanswered: DataFrame, window: int) -> DataFrame:
    """Replies for the buckets too large to gather: window texts are aggregated (partially first) and joined."""
    singles = unanswered.mapInArrow(single_windows(window), SINGLE)
    low = singles.groupBy("words").agg(F.min("least").alias("low"))
    later = singles.join(low, "words").filter(F.col("low") < F.col("least"))
    places = later.groupBy("block", "shard").agg(F.collect_list("place").alias("places"))  # of one block: bounded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [squeeze(np.sort(np.array(p, dtype="<u4")).tobytes()) for p in batch.column("places").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("shard"), pa.array(packed, pa.binary())], names=["block", "shard", "reply"]
            )

    return places.mapInArrow(run, "block long, shard long, reply binary")


def covered_words(s: Strings, ids: np.ndarray, replies: dict[int, bytes]) -> np.ndarray:
    """Which words of a block lie in a window that also starts in a document with a smaller id."""
    total = np.concatenate(([0], np.cumsum(s.lengths)))  # windows of entry i: total[i]..total[i+1]
    elsewhere = np.zeros(total[-1], dtype=bool)
    for i, bucket in enumerate(s.buckets):
        if bucket in replies:
            elsewhere[total[s.bounds[i]] + np.frombuffer(expand(replies[bucket]), dtype="<u4").astype(np.int64)] = True
    run = np.repeat(np.arange(s.starts.size), s.sizes)
    step = np.arange(run.size) - np.repeat(np.cumsum(s.sizes) - s.sizes, s.sizes)
    later = elsewhere[total[s.entry[run]] + step] | (ids[s.doc] > s.least[s.entry])[run]
    at = s.starts[run[later]] + step[later]
    edge = np.bincount(at, minlength=len(s.words) + 1) - np.bincount(at + s.window, minlength=len(s.words) + 1)[: len(s.words) + 1]
    return np.cumsum(edge)[: len(s.words)] > 0


def dedup_substrings(
    docs: DataFrame, text: str = "text", key: str = "doc_id", window: int = WINDOW, limit: int = BUCKET_LIMIT
) -> DataFrame:
    """``docs`` plus n_words, n_removed, kept (remaining words joined by one space) and kept_sha256."""
    docs = docs.drop(*[c for c in ADDED if c not in (text, key)])
    blocks = write_blocks(docs.withColumn(key, F.col(key).cast("long")), text)
    n_buckets = shards(blocks, SHARD_BYTES)
    asked = each_block(blocks, ask(text, key, window, n_buckets), "shard long, block long, blob binary")
    dealt = by_shard(asked)
    answers = cut_lineage(dealt.mapInArrow(answer(window, limit), REPLIES), "substrings")
    replies = answers.filter(F.col("reply").isNotNull()).select("block", "shard", "reply")
    unanswered = answers.filter(F.col("blob").isNotNull())
    if not unanswered.isEmpty():
        replies = replies.unionByName(answer_singles(unanswered.select("block", "shard", "blob"), window))

    def finish(block: int, rows: pa.Table, got: dict[int, bytes]) -> pa.Table:
        ids = ids_of(rows.column(key))
        s = Strings(text_bytes(rows.column(text)), ids, window, n_buckets)
        gone = covered_words(s, ids, got) if s.starts.size else np.zeros(len(s.words), dtype=bool)
        kept, bounds = s.words.joined(~gone)
        data = kept.tobytes()
        texts = [data[a : b - 1] if b > a else b"" for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        n = len(texts)
        return (
            rows.append_column("n_words", pa.array(s.words.counts, pa.int64()))
            .append_column("n_removed", pa.array(np.bincount(s.words.text[gone], minlength=n), pa.int64()))
            .append_column("kept", pa.array(texts, pa.binary()).cast(pa.string()))
            .append_column("kept_sha256", pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()))
        )

    kinds = (LongType(), LongType(), StringType(), StringType())
    fields = [StructField(key, LongType()) if f.name == key else f for f in docs.schema.fields]
    schema = StructType(fields + [StructField(a, k) for a, k in zip(ADDED, kinds)])
    return each_answered(with_answers(blocks, replies), finish, schema)


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_substrings(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")
