"""Distributed exact ranking equals row_number, including a group spanning many partitions."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from cliqueflow.operators import serving
from cliqueflow.operators.ranking import rank_within
from conftest import rows


def test_rank_within_matches_row_number_with_a_hot_group(spark):
    hot = [("hot", f"l{i:04d}", i % 37) for i in range(3000)]
    cold = [(f"p{j}", f"m{i}", i) for j in range(40) for i in range(j % 5 + 1)]
    df = spark.createDataFrame(hot + cold, "post_id string, label string, size long").repartition(7)
    order = [F.col("size").desc(), F.col("label").asc()]
    got = rank_within(df, ["post_id"], order, partitions=16)
    want = df.withColumn("rank", F.row_number().over(Window.partitionBy("post_id").orderBy(*order)))
    assert rows(got, "post_id", "label", "rank") == rows(want, "post_id", "label", "rank")
    assert got.filter(F.col("post_id") == "hot").agg(F.max("rank")).first()[0] == 3000
    # the hot group really is spread over several partitions by the range partitioning
    keys = [F.col("post_id").asc()] + order
    placed = df.repartitionByRange(16, *keys).withColumn("pid", F.spark_partition_id())
    assert placed.filter(F.col("post_id") == "hot").select("pid").distinct().count() > 1


def test_reach_ranked_with_and_without_k(spark):
    reach = spark.createDataFrame(
        [("p", "A", 3), ("p", "B", 3), ("p", "C", 1), ("q", "A", 1)], "post_id string, label string, size long")
    assert rows(serving.reach_ranked(reach)) == [("p", 1, "A", 3), ("p", 2, "B", 3), ("p", 3, "C", 1),
                                                  ("q", 1, "A", 1)]
    assert rows(serving.reach_ranked(reach, k=1)) == [("p", 1, "A", 3), ("q", 1, "A", 1)]
