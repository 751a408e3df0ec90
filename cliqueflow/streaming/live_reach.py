"""Live reach: a running count of distinct labelled retweeters per (post, community).

A stream of retweet events ``(post_id, id[, created_at])`` is de-duplicated
on (post, retweeter), joined to the static labelled table and counted. The
result equals the batch ``reach_by_community`` over the same events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.layout import bucketed_copy


def live_reach(retweet_stream: DataFrame, labelled: DataFrame) -> DataFrame:
    """Streaming (post_id, label, size). Exact: state keeps every pair of a post and a labelled retweeter."""
    return (
        retweet_stream.select("post_id", "id")
        .join(labelled.select("id", "label"), "id")
        .dropDuplicates(["post_id", "id", "label"])
        .groupBy("post_id", "label")
        .agg(F.count(F.lit(1)).alias("size"))
    )


def start_live_reach(
    spark: SparkSession,
    source: str,
    schema: StructType,
    labelled: DataFrame,
    output: str,
    checkpoint: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    processing_time: str = "30 seconds",
    static_buckets: int | None = None,
    output_mode: str = "update",
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Run ``live_reach`` over a folder of parquet retweet events.

    In ``update`` mode (default) every micro-batch appends only the counts it
    changed, tagged with its epoch, to ``output``; ``read_live_reach`` gives
    the current count per (post, label). A replayed epoch appends the same
    rows again, which the reader collapses, so the sink is idempotent. In
    ``complete`` mode every micro-batch replaces ``output`` with all counts.
    ``available_now`` drains what is there and stops; otherwise the query
    polls every ``processing_time``.

    A stream-static join re-runs the static side in every micro-batch. With
    ``static_buckets`` the labelled table is first stored bucketed on ``id``,
    so each batch shuffles only its own events, never the labelled table.

    Without ``checkpoint`` it lies beside ``output``, so a restart on the same
    output goes on with its counts. Counts of labels that have changed need a
    new output: the old one's state was built with the labels of its time.

    ``state_partitions`` fixes the number of state-store partitions for the
    life of the checkpoint (default: the session's shuffle partitions).
    """
    if static_buckets:
        labelled, _, _ = bucketed_copy(labelled.select("id", "label"), "id", static_buckets, "live-reach-labels")
    own = spark
    if state_partitions:
        # read when the query starts and then kept in its checkpoint; a session of its own leaves the caller's as it is
        own = spark.newSession()
        own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
        own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    reader = own.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    counts = live_reach(reader.parquet(source), labelled)

    def publish(batch: DataFrame, epoch_id: int) -> None:
        if output_mode == "complete":
            batch.withColumn("epoch", F.lit(epoch_id).cast("long")).write.mode("overwrite").parquet(output)
        else:
            batch.withColumn("epoch", F.lit(epoch_id).cast("long")).write.mode("append").parquet(output)

    writer = (
        counts.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint or output.rstrip("/") + "-checkpoint")
        .foreachBatch(publish)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()


def read_live_reach(spark: SparkSession, output: str) -> DataFrame:
    """Current (post_id, label, size) from a live-reach sink: the latest epoch's count per key."""
    return (
        spark.read.parquet(output)
        .groupBy("post_id", "label")
        .agg(F.max_by("size", "epoch").alias("size"))
    )
