"""Exact row numbers within groups of any size, without a group ever sitting in one task.

``row_number() over (partition by g order by o)`` sends a whole group to one
task. Here the rows are range-partitioned on ``(g, o)`` instead (a huge group
spans several partitions), sorted within partitions and stored with their
partition id and a within-partition row id. A group's rows in one partition
are then consecutive, so the row number is the count of its rows in earlier
partitions plus the offset inside this one. The per-(partition, group)
count table has at most one row per partition a group spans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def rank_within(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    name: str = "rank",
    partitions: int | None = None,
) -> DataFrame:
    """``df`` plus ``name``: 1-based row number within ``group`` by ``order`` (a total order).

    Group columns must not be null.
    """
    keys = [F.col(g).asc() for g in group] + list(order)
    # without a fixed count AQE may merge adjacent ranges, which keeps the order intact
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    placed, _ = materialize(
        ranged
        .sortWithinPartitions(*keys)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_rid", F.monotonically_increasing_id()),
        "rank-within",
    )
    earlier = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_pid", *group)
        .agg(F.min("_rid").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .drop("_n")
    )
    return (
        placed.join(offsets, ["_pid", *group])
        .withColumn(name, (F.col("_before") + F.col("_rid") - F.col("_first") + 1).cast("long"))
        .drop("_pid", "_rid", "_first", "_before")
    )
