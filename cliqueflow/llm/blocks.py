"""Blocks of documents, and questions that blocks put to shards of the corpus.

A block is a bounded run of rows (about ``size`` bytes of text) packed into one
compressed binary, stored once in the shared scratch folder. Operators that
need facts about the whole corpus let every block send one packed question to
each shard it needs, let the shard answer, and join the answers back to the
block. So the shuffles carry few, packed, pre-aggregated rows, and no key is
ever gathered document by document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_path, scratch_path, ship_package

BLOCK_BYTES = 4 << 20
BLOCK_SCHEMA = "block long, rows long, payload binary"


def squeeze(data: bytes, level: int = 3) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(data)


def expand(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def pack_table(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return squeeze(sink.getvalue().to_pybytes())


def unpack_table(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(expand(payload)).read_all()


def text_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """Texts as UTF-8; a null counts as empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def pieces(batches: Iterator[pa.RecordBatch], text: str, size: int) -> Iterator[pa.Table]:
    """Consecutive rows of a task as tables of about ``size`` bytes of text (one row at least)."""
    held: list[pa.RecordBatch] = []
    room = size
    for batch in batches:
        if not batch.num_rows:
            continue
        lens = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        upto = np.cumsum(lens.astype(np.int64) + 64)
        at = 0
        while at < batch.num_rows:
            before = upto[at - 1] if at else 0
            stop = max(at + (not held), int(np.searchsorted(upto, before + room, side="right")))
            if stop > at:
                held.append(batch.slice(at, stop - at))
                room -= int(upto[stop - 1] - before)
            at = stop
            if room <= 0 or at < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, room = [], size
    if held:
        yield pa.Table.from_batches(held)


def write_blocks(df: DataFrame, text: str, size: int = BLOCK_BYTES) -> DataFrame:
    """Store all rows and columns of ``df`` as blocks in the shared scratch folder; the reread table.

    Block numbers are written with the rows, so a later recomputation of any
    stage sees the same blocks.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for n, table in enumerate(pieces(batches, text, size)):
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([(task << 32) + n], pa.int64()),
                    "rows": pa.array([table.num_rows], pa.int64()),
                    "payload": pa.array([pack_table(table)], pa.binary()),
                }
            )

    ship_package(df.sparkSession)
    path = scratch_path(df.sparkSession, "blocks")
    df.mapInArrow(pack, BLOCK_SCHEMA).write.option("compression", "none").parquet(path)
    return df.sparkSession.read.parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete stored scratch tables that nothing reads any more."""
    for table in tables:
        files = table.inputFiles()
        if files:
            drop_path(table.sparkSession, files[0].rsplit("/", 1)[0])


def each_block(
    blocks: DataFrame, work: Callable[[int, pa.Table], Iterator[dict]], schema: str
) -> DataFrame:
    """Rows that ``work(block number, rows)`` yields, column by column, for every block."""
    names = [f.split()[0] for f in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, payload in zip(batch.column("block").to_pylist(), batch.column("payload")):
                rows = list(work(block, unpack_table(payload.as_py())))
                if rows:
                    yield pa.RecordBatch.from_pydict({k: [r[k] for r in rows] for k in names}, arrow_schema)

    arrow_schema = arrow_of(schema)
    return blocks.select("block", "payload").mapInArrow(run, schema)


def arrow_of(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_()}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in schema.split(",")])


def with_answers(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    """Every block with its answers (block, shard, reply) as one list, possibly null."""
    mine = answers.groupBy("block").agg(F.collect_list(F.struct("shard", "reply")).alias("answers"))
    return blocks.select("block", "payload").join(mine, "block", "left")


def each_answered(
    joined: DataFrame, work: Callable[[int, pa.Table, dict[int, bytes]], pa.Table], schema: str
) -> DataFrame:
    """``work(block number, rows, replies by shard)`` for every row of ``with_answers``; it returns a table of ``schema``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                got = batch.column("answers")[i].as_py() or []
                rows = unpack_table(batch.column("payload")[i].as_py())
                yield from work(batch.column("block")[i].as_py(), rows, {a["shard"]: a["reply"] for a in got}).to_batches()

    return joined.mapInArrow(run, schema)


def grouped(
    batches: Iterator[pa.RecordBatch], key: str
) -> Iterator[tuple[object, Iterator[dict]]]:
    """Runs of equal ``key`` in a task whose rows are sorted by it; each run must be read to its end."""
    rows = ({k: batch.column(k)[i].as_py() for k in batch.schema.names} for batch in batches for i in range(batch.num_rows))
    row = next(rows, None)
    while row is not None:
        now = row[key]

        def run() -> Iterator[dict]:
            nonlocal row
            while row is not None and row[key] == now:
                yield row
                row = next(rows, None)

        yield now, run()


def by_shard(asked: DataFrame) -> DataFrame:
    """Questions in runs of one shard each. A task walks many shards in turn: a shard is what it holds at a time, and
    the number of tasks is the session's number of shuffle partitions, however many shards the corpus has."""
    return asked.repartition("shard").sortWithinPartitions("shard")


def shards(blocks: DataFrame, size: int, least: int | None = None) -> int:
    """Number of shards so that one gets what about ``size`` bytes of packed blocks send."""
    total = blocks.select(F.sum(F.length("payload"))).first()[0] or 0
    least = least or int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-total // size))
