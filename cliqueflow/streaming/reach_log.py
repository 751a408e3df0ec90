"""Live reach with state that ends and files that stay few.

A micro-batch appends its (post, retweeter) pairs to a log, one folder an
epoch. With a ``repeat_window``, repeats that follow each other within it never
reach the log: a keyed state drops them, and the watermark ends it; retweets
that come later than the window behind the newest one are late data. Every ``merge_every``
epochs the log is merged into a snapshot: the distinct pairs of the posts that
are still open, their counts, and the final counts of closed ones. A post is
closed, and its pairs are dropped, when it has had no retweet for ``ttl`` of
event time; a later retweet of it is not counted. Without ``ttl`` no post is
closed, and without both counts are exact for ever, in whatever order events come.

Folders below the output, all written whole before anything refers to them:

    log/<epoch>                 post_id, id, created_at
    pairs/<n>, reach/<n>, closed/<n>
                                a snapshot; ``closed`` is written last and so completes it. Its number is the
                                epoch up to which it counts, times VERSIONS, plus one for each relabelling

A replayed epoch writes its folder again, or is skipped once it is merged.
What a snapshot replaces is deleted one snapshot later, so a reader that has
just listed it can finish.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.serving import reach_by_community
from ..session import drop_path, finished_parts

PAIRS = "post_id string, id string, created_at timestamp"
REACH = "post_id string, label string, size long"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Snapshots of one epoch at most.
VERSIONS = 10_000


def _name(number: int) -> str:
    return f"{number:018d}"


class ReachLog:
    """The folders of one output, in one session."""

    def __init__(self, spark: SparkSession, output: str, ttl: str | None = None, keep: int = 2):
        self.spark, self.output, self.ttl, self.keep = spark, output.rstrip("/"), ttl, keep

    def parts(self, kind: str) -> list[int]:
        return [int(n) for n in finished_parts(self.spark, f"{self.output}/{kind}")]

    def snapshot(self) -> int:
        """Number of the latest complete snapshot, -1 if there is none."""
        return max(self.parts("closed"), default=-1)

    def unmerged(self, after: int) -> list[int]:
        """Epochs of the log behind a snapshot."""
        return [e for e in self.parts("log") if e > after // VERSIONS]

    def table(self, kind: str, numbers: list[int], schema: str) -> DataFrame:
        paths = [f"{self.output}/{kind}/{_name(n)}" for n in numbers if n >= 0]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def append(self, batch: DataFrame, epoch: int) -> None:
        """The pairs of a micro-batch, unless a snapshot has them already."""
        if epoch <= self.snapshot() // VERSIONS:
            batch.write.format("noop").mode("overwrite").save()  # the state of a replayed batch is still written
            return
        pairs = batch.groupBy("post_id", "id").agg(F.max("created_at").alias("created_at"))
        pairs.write.mode("overwrite").parquet(f"{self.output}/log/{_name(epoch)}")

    def tail(self, after: int) -> DataFrame:
        return self.table("log", self.unmerged(after), PAIRS)

    def open_pairs(self, after: int) -> DataFrame:
        """Distinct pairs of the snapshot's open posts and of the log behind it."""
        closed = self.table("closed", [after], REACH).select("post_id").distinct()
        new = self.tail(after).join(closed, "post_id", "left_anti")
        both = self.table("pairs", [after], PAIRS).unionByName(new)
        return both.groupBy("post_id", "id").agg(F.max("created_at").alias("created_at"))

    def merge(self, labelled: DataFrame) -> None:
        """Make the snapshot of all that the log has; with nothing new, count anew by ``labelled``."""
        after = self.snapshot()
        new = self.unmerged(after)
        if after < 0 and not new:
            return
        upto = max(new) * VERSIONS if new else after + 1
        pairs = self.open_pairs(after)
        ended = self.table("closed", [after], REACH)
        if self.ttl:
            last = pairs.groupBy("post_id").agg(F.max("created_at").alias("last"))
            newest = last.agg(F.max("last") - F.expr(f"INTERVAL {self.ttl}")).first()[0]
            old = last.filter(F.col("last") < F.lit(newest)).select("post_id")
            ended = ended.unionByName(reach_by_community(pairs.join(old, "post_id", "left_semi"), labelled))
            # a post without a labelled retweeter is closed as well: one row without a label
            none = old.join(ended.select("post_id").distinct(), "post_id", "left_anti")
            ended = ended.unionByName(none.select("post_id", F.lit(None).cast("string").alias("label"), F.lit(0).cast("long").alias("size")))
            pairs = pairs.join(old, "post_id", "left_anti")
        at = _name(upto)
        pairs.write.mode("overwrite").parquet(f"{self.output}/pairs/{at}")
        kept = self.table("pairs", [upto], PAIRS)
        reach_by_community(kept, labelled).write.mode("overwrite").parquet(f"{self.output}/reach/{at}")
        ended.coalesce(self.spark.sparkContext.defaultParallelism).write.mode("overwrite").parquet(f"{self.output}/closed/{at}")
        self.clean()

    def clean(self) -> None:
        """Drop what the last snapshots replace."""
        held = self.parts("closed")[-self.keep :]
        for kind in ("closed", "reach", "pairs"):
            for e in self.parts(kind):
                if e < held[0]:
                    drop_path(self.spark, f"{self.output}/{kind}/{_name(e)}")
        for e in self.parts("log"):
            if e <= held[0] // VERSIONS:
                drop_path(self.spark, f"{self.output}/log/{_name(e)}")

    def reach(self, labelled: DataFrame) -> DataFrame:
        """(post_id, label, size) now: the snapshot's counts, those of posts in the log counted anew."""
        after = self.snapshot()
        counted = self.table("closed", [after], REACH).filter("size > 0").unionByName(self.table("reach", [after], REACH))
        if not self.unmerged(after):
            return counted
        closed = self.table("closed", [after], REACH).select("post_id")
        moved = self.tail(after).join(closed, "post_id", "left_anti").select("post_id").distinct()
        anew = reach_by_community(self.open_pairs(after).join(moved, "post_id", "left_semi"), labelled)
        return counted.join(moved, "post_id", "left_anti").unionByName(anew)


def start_reach_log(
    spark: SparkSession,
    source: str,
    schema: StructType,
    labels: str,
    output: str,
    ttl: str | None = None,
    repeat_window: str | None = None,
    merge_every: int = 8,
    checkpoint: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    processing_time: str = "30 seconds",
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Follow a folder of retweet events (post_id, id, created_at) into the log at ``output``.

    ``labels`` is the path of the stored labelled table. A restart goes on
    from the checkpoint (by default beside ``output``); after a relabelling it
    may name another table, and ``ReachLog.merge`` counts open posts anew.
    ``repeat_window`` and ``state_partitions`` belong to the checkpoint.

    The query has a session of its own, so neither the RocksDB state store nor
    the number of state partitions changes the caller's settings.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    if state_partitions:
        own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    reader = own.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    events = reader.parquet(source).select("post_id", "id", F.col("created_at").cast("timestamp")).filter("post_id IS NOT NULL AND id IS NOT NULL")
    if repeat_window:
        events = events.withWatermark("created_at", repeat_window).dropDuplicatesWithinWatermark(["post_id", "id"])

    def publish(batch: DataFrame, epoch: int) -> None:
        log = ReachLog(batch.sparkSession, output, ttl)
        log.append(batch, epoch)
        if len(log.unmerged(log.snapshot())) >= merge_every:
            log.merge(batch.sparkSession.read.parquet(labels))

    writer = events.writeStream.option("checkpointLocation", checkpoint or output.rstrip("/") + "-checkpoint").foreachBatch(publish)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)).start()
