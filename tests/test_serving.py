"""Serving queries (H12) and keyed sinks."""

import pytest

from cliqueflow.operators import serving
from cliqueflow.sources import files
from conftest import rows


def test_h12_reach_counts_distinct_labelled_retweeters(spark):
    rt = spark.createDataFrame([("p", "a"), ("p", "a"), ("p", "b"), ("p", "c")], "post_id string, id string")
    lab = spark.createDataFrame([("a", "Trump"), ("b", "Biden")], "id string, label string")
    reach = serving.reach_by_community(rt, lab)
    assert rows(reach) == [("p", "Biden", 1), ("p", "Trump", 1)]
    assert rows(serving.reach_ranked(reach)) == [("p", 1, "Biden", 1), ("p", 2, "Trump", 1)]
    assert rows(serving.reach_by_community(rt, lab, post_id="q")) == []


def test_timeline_latest_first(spark):
    posts = spark.createDataFrame(
        [("u", "1", "2024-01-01 00:00:00", None), ("u", "2", "2024-01-03 00:00:00", None),
         ("u", "3", "2024-01-02 00:00:00", "9"), ("v", "4", "2024-01-01 00:00:00", None)],
        "author_id string, id string, created_at string, rt_post_id string")
    out = rows(serving.user_timeline(posts, n=2), "author_id", "position", "id")
    assert out == [("u", 1, "2"), ("u", 2, "3"), ("v", 1, "4")]


def test_timeline_ties_by_number(spark):
    posts = spark.createDataFrame([("u", i, "2024-01-01", None) for i in ("9", "10", "8")],
                                  "author_id string, id string, created_at string, rt_post_id string")
    assert [r[1] for r in rows(serving.user_timeline(posts), "position", "id")] == ["10", "9", "8"]


def test_profile_by_name(spark):
    us = spark.createDataFrame([("1", "alice"), ("2", "bob")], "id string, screen_name string")
    assert rows(serving.user_profile(us, ["bob"])) == [("2", "bob")]
    names = spark.createDataFrame([("alice",), ("zed",)], "n string")
    assert rows(serving.user_profile(us, names)) == [("1", "alice")]


def test_keyed_sink_refuses_duplicate_keys_and_existing_table(spark, tmp_path):
    lab = spark.createDataFrame([("1", "A"), ("1", "B")], "id string, label string")
    with pytest.raises(ValueError, match="not unique"):
        files.write_keyed(serving.keyed_users(lab), str(tmp_path / "kv"), "key")
    ok = spark.createDataFrame([("1", "A"), ("2", "B")], "id string, label string")
    files.write_keyed(serving.keyed_users(ok), str(tmp_path / "kv"), "key")
    assert rows(spark.read.parquet(str(tmp_path / "kv")), "key") == [("user:1",), ("user:2",)]
    with pytest.raises(Exception):
        files.write_keyed(serving.keyed_users(ok), str(tmp_path / "kv"), "key")
