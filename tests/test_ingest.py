"""Raw JSON scan and cleaning (H8, H9)."""

import json

from cliqueflow.operators import ingest
from cliqueflow.sources import files
from conftest import rows


def user(uid, name, followers=1):
    return {"id": uid, "screen_name": name, "statuses_count": 1, "followers_count": followers,
            "friends_count": 1, "description": "d"}


def write_lines(path, lines):
    path.mkdir()
    (path / "part-0.json").write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def h8_lines():
    return [
        json.dumps({"id": "1", "lang": "en", "user": user(7, "seven"),
                    "retweeted_status": {"id": "100", "user": user(8, "eight")}}),
        json.dumps({"delete": {"status": {"id": 5, "user_id": 7}}}),
        '{"id": "2", "lang": "en", "user": {',
        json.dumps({"id": "3", "lang": "fr", "user": user(9, "neuf"),
                    "retweeted_status": {"id": "101", "user": user(8, "eight")}}),
        json.dumps({"id": "4", "lang": "en", "user": user(10, "ten"),
                    "retweeted_status": {"id": "102", "user": user(11, "eleven")},
                    "quoted_status": {"id": "103", "user": user(12, "twelve")}}),
    ]


def test_h8_references_from_json(spark, tmp_path):
    tweets = files.read_tweets(spark, write_lines(tmp_path / "raw", h8_lines()))
    assert rows(ingest.gather_references(tweets)) == [("10", "11"), ("10", "12"), ("7", "8")]


def test_h8_users_from_json(spark, tmp_path):
    tweets = files.read_tweets(spark, write_lines(tmp_path / "raw", h8_lines()))
    assert sorted(r["id"] for r in ingest.all_users(tweets).collect()) == ["10", "11", "12", "7", "8"]
    assert sorted(r["id"] for r in ingest.tweeters(tweets).collect()) == ["10", "7"]
    assert [r["id"] for r in ingest.quoted_users(tweets).collect()] == ["12"]
    assert sorted(r["id"] for r in ingest.retweeted_users(tweets).collect()) == ["11", "8"]
    # numeric JSON ids become strings at the boundary
    assert dict(ingest.clean_users(tweets).dtypes)["id"] == "string"


def test_h9_dedupe_tie_break(spark):
    data = [("7", "bob", 1, 3, 1, "d"), ("7", "bob", 1, 5, 1, "d"), ("7", "alice", 9, 9, 9, "d"),
            ("7", None, 9, 9, 9, "d"), (None, "ghost", 1, 1, 1, "d")]
    df = spark.createDataFrame(
        data, "id string, screen_name string, statuses_count long, followers_count long, "
              "friends_count long, description string")
    out = ingest.dedupe_users(df).collect()
    assert len(out) == 1 and (out[0]["screen_name"], out[0]["followers_count"]) == ("bob", 5)


def test_json_round_trip_keeps_nested_shape(spark, tmp_path):
    from cliqueflow.sources.social import SocialTables

    t = SocialTables(spark, "/root/testdata/sf0.001")
    path = str(tmp_path / "tweets")
    files.write_tweets(t.tweets, path)
    back = files.read_tweets(spark, path)
    assert rows(ingest.gather_references(back)) == rows(ingest.gather_references(t.tweets))


def test_profiles_of_all_roles_by_one_join(spark):
    schema = "id string, screen_name string, statuses_count long, followers_count long, friends_count long, description string"
    profiles = spark.createDataFrame([("1", "a", 1, 1, 1, "x"), ("1", "b", 1, 1, 1, "x"), ("2", "c", 2, 2, 2, None), (None, "n", 0, 0, 0, "")], schema)
    mentions = spark.createDataFrame([("1",), ("1",), ("3",), (None,), (None,)], "id string")
    got = ingest.with_profiles(mentions, profiles)
    assert got.dtypes == profiles.dtypes
    none = (None,) * 5
    assert rows(got, "id", "screen_name") == [("1", "a"), ("1", "a"), ("1", "b"), ("1", "b"), ("3", None), (None, None), (None, None)]
    assert [tuple(r)[1:] for r in got.filter("id is null or id = '3'").collect()] == [none] * 3
    unique = ingest.dedupe_users(ingest.with_profiles(mentions.distinct(), profiles, spread_nulls=False))
    assert rows(unique, "id", "screen_name") == [("1", "b"), ("3", None)]


def test_user_ids_are_distinct_over_roles(spark, tmp_path):
    tweets = files.read_tweets(spark, write_lines(tmp_path / "raw", h8_lines()))
    assert rows(ingest.user_ids(tweets)) == [("10",), ("11",), ("12",), ("7",), ("8",)]
    assert rows(ingest.user_ids(tweets, None)) == [("10",), ("11",), ("12",), ("7",), ("8",), ("9",)]


def test_posts_carry_at_most_one_profile_through_a_shuffle(spark):
    """The one user that a post quotes or retweets is joined once, and authors join the orders; raw posts are packed."""
    import contextlib
    import io

    from cliqueflow.session import scratch_path
    from cliqueflow.sources import files
    from cliqueflow.sources.social import SocialTables

    t = SocialTables(spark, "/root/testdata/sf0.001")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        t.tweets.explain()
    assert buf.getvalue().count("LeftOuter") == 2
    path = scratch_path(spark, "packed")
    files.write_tweets(t.tweets.limit(50), path)
    assert all(f.endswith(".json.gz") for f in spark.read.text(path).inputFiles())
    assert files.read_tweets(spark, path).count() == 50
