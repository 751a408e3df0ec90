"""Live reach: the streaming counts equal the batch counts over the same events."""

import contextlib
import io

from pyspark.sql import functions as F

from cliqueflow.operators import serving
from cliqueflow.streaming.live_reach import read_live_reach, start_live_reach
from conftest import rows


def test_stream_equals_batch(spark, tmp_path):
    events = spark.createDataFrame(
        [("p1", "a", "2024-01-01"), ("p1", "a", "2024-01-02"), ("p1", "b", "2024-01-02"),
         ("p2", "c", "2024-01-03"), ("p2", "a", "2024-01-03"), ("p1", "z", "2024-01-04")],
        "post_id string, id string, day string")
    src = str(tmp_path / "events")
    events.write.partitionBy("day").parquet(src)
    lab = spark.createDataFrame([("a", "Trump"), ("b", "Trump"), ("c", "Biden")], "id string, label string")
    out = str(tmp_path / "out")
    q = start_live_reach(spark, src, events.schema, lab, out, checkpoint=str(tmp_path / "ckpt"),
                         max_files_per_trigger=1)
    q.awaitTermination()
    assert len(q.recentProgress) >= 2  # several micro-batches
    got = rows(read_live_reach(spark, out), "post_id", "label", "size")
    want = rows(serving.reach_by_community(events, lab), "post_id", "label", "size")
    assert got == want == [("p1", "Trump", 2), ("p2", "Biden", 1), ("p2", "Trump", 1)]


def test_stream_with_bucketed_static_side(spark, tmp_path):
    events = spark.createDataFrame(
        [("p1", "a", "2024-01-01"), ("p1", "b", "2024-01-02"), ("p2", "a", "2024-01-03")],
        "post_id string, id string, day string")
    src = str(tmp_path / "events")
    events.write.partitionBy("day").parquet(src)
    lab = spark.createDataFrame([("a", "Trump"), ("b", "Biden")], "id string, label string")
    out = str(tmp_path / "out")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        q = start_live_reach(spark, src, events.schema, lab, out, checkpoint=str(tmp_path / "ckpt"),
                             static_buckets=4)
        q.awaitTermination()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            q.explain()
        scan = [line for line in buf.getvalue().splitlines() if "cliqueflow_live_reach_labels" in line]
        assert scan and "Bucketed: true" in scan[0], buf.getvalue()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    assert rows(read_live_reach(spark, out), "post_id", "label", "size") == [
        ("p1", "Biden", 1), ("p1", "Trump", 1), ("p2", "Trump", 1)]


def test_complete_mode_gives_the_same_counts(spark, tmp_path):
    events = spark.createDataFrame(
        [("p1", "a", "2024-01-01"), ("p1", "b", "2024-01-02"), ("p1", "a", "2024-01-03")],
        "post_id string, id string, day string")
    src = str(tmp_path / "events")
    events.write.partitionBy("day").parquet(src)
    lab = spark.createDataFrame([("a", "Trump"), ("b", "Trump")], "id string, label string")
    out = str(tmp_path / "out")
    q = start_live_reach(spark, src, events.schema, lab, out, checkpoint=str(tmp_path / "ckpt"),
                         max_files_per_trigger=1, output_mode="complete")
    q.awaitTermination()
    assert rows(read_live_reach(spark, out), "post_id", "label", "size") == [("p1", "Trump", 2)]


def test_restart_on_the_same_output_goes_on(spark, tmp_path):
    schema = "post_id string, id string, day string"
    src, out = str(tmp_path / "events"), str(tmp_path / "out")
    lab = spark.createDataFrame([("a", "Trump"), ("b", "Trump")], "id string, label string")
    seen = []
    for more in ([("p1", "a", "2024-01-01"), ("p1", "x", "2024-01-01")], [("p1", "a", "2024-01-02"), ("p1", "b", "2024-01-02")]):
        seen += more
        events = spark.createDataFrame(more, schema)
        events.write.mode("append").partitionBy("day").parquet(src)
        start_live_reach(spark, src, events.schema, lab, out).awaitTermination()
        want = serving.reach_by_community(spark.createDataFrame(seen, schema), lab)
        assert rows(read_live_reach(spark, out), "post_id", "label", "size") == rows(want, "post_id", "label", "size")
