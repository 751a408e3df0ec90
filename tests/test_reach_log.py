"""The log of live reach: equal to the batch counts over restarts, replays and relabelling; state and files stay small."""

import random
from datetime import datetime, timedelta

from cliqueflow.operators import serving
from cliqueflow.streaming.reach_log import ROCKSDB, VERSIONS, ReachLog, start_reach_log
from conftest import rows

SCHEMA = "post_id string, id string, created_at timestamp"
START = datetime(2024, 1, 1)


def labels(spark, path, pairs):
    spark.createDataFrame(pairs, "id string, label string").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def feed(spark, path, events):
    spark.createDataFrame(events, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def follow(spark, tmp_path, **options):
    schema = spark.createDataFrame([], SCHEMA).schema
    q = start_reach_log(spark, str(tmp_path / "events"), schema, str(tmp_path / options.pop("labels", "labels")), str(tmp_path / "out"), state_partitions=2, **options)
    q.awaitTermination()
    return q


def test_epochs_restarts_and_relabelling_equal_the_batch(spark, tmp_path):
    rng = random.Random(2)
    lab = labels(spark, str(tmp_path / "labels"), [(f"u{i}", "AB"[i % 2]) for i in range(12)])
    log = ReachLog(spark, str(tmp_path / "out"))
    seen = []
    for epoch in range(20):
        events = [(f"p{rng.randint(0, 5)}", f"u{rng.randint(0, 14)}", START + timedelta(minutes=10 * epoch + rng.randint(0, 9))) for _ in range(9)]
        feed(spark, str(tmp_path / "events"), events + events[:3])
        seen += events
        follow(spark, tmp_path, merge_every=4, repeat_window="15 minutes")
        if epoch % 5 == 4:
            want = rows(serving.reach_by_community(spark.createDataFrame(seen, SCHEMA), lab))
            assert rows(log.reach(lab)) == want
    assert len(log.parts("log")) <= 9 and all(len(log.parts(k)) <= 2 for k in ("pairs", "reach", "closed"))
    # an epoch that is replayed changes nothing, merged or not
    log.append(spark.createDataFrame(seen[:5], SCHEMA), log.snapshot() // VERSIONS)
    last = max(log.parts("log"))
    again = [tuple(r) for r in log.table("log", [last], SCHEMA).collect()]
    log.append(spark.createDataFrame(again, SCHEMA), last)
    assert rows(log.reach(lab)) == want
    other = labels(spark, str(tmp_path / "labels-2"), [(f"u{i}", "XYZ"[i % 3]) for i in range(15)])
    log.merge(other)
    assert rows(log.reach(other)) == rows(serving.reach_by_community(spark.createDataFrame(seen, SCHEMA), other))
    feed(spark, str(tmp_path / "events"), [("p0", "u14", START + timedelta(days=1))])
    follow(spark, tmp_path, labels="labels-2", repeat_window="15 minutes")
    seen.append(("p0", "u14", START))
    assert rows(log.reach(other)) == rows(serving.reach_by_community(spark.createDataFrame(seen, SCHEMA), other))


def test_state_ends_and_quiet_posts_are_closed(spark, tmp_path):
    lab = labels(spark, str(tmp_path / "labels"), [(f"u{i}", "A") for i in range(50)])
    batches = [
        [("old", f"u{i}", START) for i in range(40)] + [("silent", "nobody", START)],
        [("new", "u1", START + timedelta(hours=5))],
        [("new", "u2", START + timedelta(hours=6))],
        [("old", "u49", START + timedelta(hours=6)), ("new", "u2", START + timedelta(hours=6))],
    ]
    held = []
    for events in batches:
        feed(spark, str(tmp_path / "events"), events)
        q = follow(spark, tmp_path, ttl="2 hours", repeat_window="30 minutes", merge_every=1)
        held.append(q.recentProgress[-1].stateOperators[0])
    assert held[0].numRowsTotal == 41 and held[-1].numRowsTotal <= 3
    assert any("rocksdb" in k.lower() for k in held[0].customMetrics)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != ROCKSDB
    log = ReachLog(spark, str(tmp_path / "out"), ttl="2 hours")
    at = log.snapshot()
    assert {r.post_id for r in log.table("pairs", [at], SCHEMA).collect()} == {"new"}
    assert {r.post_id for r in log.table("closed", [at], "post_id string").collect()} == {"old", "silent"}
    # the late retweet of a closed post is not counted, its final counts stay
    assert rows(log.reach(lab)) == [("new", "A", 2), ("old", "A", 40)]
