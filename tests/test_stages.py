"""Stage runner: raw JSON to keyed tables, each stage rereadable on its own."""

import json

import pytest

from cliqueflow.plans.stages import StageOptions, read_manifest, run_stage
from cliqueflow.schemas import Paths
from cliqueflow.sources import files


def user(uid, name, followers):
    return {"id": uid, "screen_name": name, "statuses_count": 1, "followers_count": followers,
            "friends_count": 1, "description": "d"}


def test_all_stages_round_trip(spark, tmp_path):
    paths = Paths(str(tmp_path))
    (tmp_path / "raw").mkdir()
    lines = []
    # 1 and 2 retweet seed 10 (Trump); 3 retweets 1; 4 quotes seed 20 (Biden) twice
    for src, dst in [(1, 10), (2, 10), (3, 1), (3, 1)]:
        lines.append({"id": f"{src}-{dst}", "lang": "en", "user": user(src, f"u{src}", src),
                      "retweeted_status": {"id": f"p{dst}", "user": user(dst, f"u{dst}", dst)}})
    for _ in range(2):
        lines.append({"id": "q", "lang": "en", "user": user(4, "u4", 4),
                      "quoted_status": {"id": "p20", "user": user(20, "u20", 20)}})
    (tmp_path / "raw" / "a.json").write_text("\n".join(json.dumps(x) for x in lines))
    (tmp_path / "prelabelled").mkdir()
    (tmp_path / "prelabelled" / "s.json").write_text(
        '{"id": "10", "label": "Trump", "prelabelled": true}\n{"id": "20", "label": "Biden", "prelabelled": true}\n')

    run_stage(spark, "all", paths, StageOptions(keep_sinks=True))

    edges = {(r["src"], r["dst"]): r["weight"] for r in files.read_stage(spark, paths["edges"]).collect()}
    assert edges == {("1", "10"): 1, ("2", "10"): 1, ("3", "1"): 2, ("4", "20"): 2}
    lab = {r["id"]: r["label"] for r in files.read_stage(spark, paths["labelled"]).collect()}
    assert lab == {"1": "Trump", "2": "Trump", "3": "Trump", "4": "Biden", "10": "Trump", "20": "Biden"}
    comms = {r["name"]: (r["size"], r["influencers"]) for r in files.read_stage(spark, paths["communities"]).collect()}
    assert comms == {"Trump": (4, ["u10", "u3", "u2", "u1"]), "Biden": (2, ["u20", "u4"])}
    kv = {r["key"]: r["label"] for r in spark.read.parquet(paths["kv_users"]).collect()}
    assert kv["user:3"] == "Trump"
    kvc = {r["key"] for r in spark.read.parquet(paths["kv_communities"]).collect()}
    assert kvc == {"communities:Trump", "communities:Biden"}


def test_connectors_get_plain_keys(spark, tmp_path, monkeypatch):
    paths = Paths(str(tmp_path))
    spark.createDataFrame([("1", "A")], "id string, label string").write.parquet(paths["labelled"])
    got = []
    monkeypatch.setattr(files, "write_keyed", lambda df, table, key, **kw: got.append((df.columns, table, key, kw["fmt"])))
    run_stage(spark, "kv_users", paths, StageOptions(kv_format="some.kv.store"))
    assert got == [(["id", "label"], "user", "id", "some.kv.store")]


def test_from_raw_lines_to_reach_and_timelines(spark, tmp_path):
    paths = Paths(str(tmp_path))
    (tmp_path / "raw").mkdir()
    days = ["Fri Mar 01 08:00:00 +0000 2019", "Mon Mar 04 08:00:00 +0100 2019", "Sun Mar 03 23:59:59 +0000 2019", "2019-03-02 10:00:00"]
    posts = [
        {"id": str(i), "lang": "en", "created_at": d, "text": f"t{i}", "retweet_count": i, "favorite_count": 2 * i, "user": user(1, "u1", 1)}
        for i, d in enumerate(days)
    ]
    posts.append({"id": "9", "lang": "en", "created_at": days[0], "user": user(2, "u2", 2), "retweeted_status": {"id": "0", "user": user(1, "u1", 1)}})
    posts.append({"id": "8", "lang": "fr", "created_at": days[0], "user": user(3, "u3", 2)})
    lines = [json.dumps(p) for p in posts] + ['{"id": "7", "lang": "en", "user"', "not json"] + [json.dumps({"delete": {"status": {"id": 5}}})] * 3
    (tmp_path / "raw" / "a.json").write_text("\n".join(lines) + "\n")
    run_stage(spark, "ingestion", paths)
    spark.createDataFrame([("2", "Trump")], "id string, label string").write.parquet(paths["labelled"])
    run_stage(spark, "serve", paths, StageOptions(timeline_n=3))

    told = {r.output: r.rows for r in read_manifest(spark, paths).collect()}
    assert {k.removeprefix("input."): v for k, v in told.items() if k.startswith("input.")} == {"lines": 11, "broken": 2, "deletes": 3, "posts": 6}
    assert told["rejected"] == 2 and told["posts"] == 5 and told["retweets"] == 1 and told["reach"] == 1 and told["users"] == 2
    assert sorted(r.line for r in files.read_stage(spark, paths["rejected"]).collect()) == sorted(lines[6:8])
    # order of time, not of weekdays' names
    shown = [tuple(r) for r in files.read_stage(spark, paths["timeline"]).filter("author_id = '1'").orderBy("position").drop("created_at", "author_id").collect()]
    assert shown == [(1, "1", None, "t1", 1, 2), (2, "2", None, "t2", 2, 4), (3, "3", None, "t3", 3, 6)]
    assert [tuple(r) for r in files.read_stage(spark, paths["reach"]).collect()] == [("0", 1, "Trump", 1)]


def test_vertices_stage_writes_the_keyed_users(spark, tmp_path):
    paths = Paths(str(tmp_path))
    spark.createDataFrame([("1", "A")], "id string, label string").write.parquet(paths["labelled"])
    run_stage(spark, "vertices", paths)
    assert [r.key for r in spark.read.parquet(paths["kv_users"]).collect()] == ["user:1"]


def test_unknown_stage(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown stage"):
        run_stage(spark, "upload", Paths(str(tmp_path)))


def test_command_line(spark, tmp_path):
    from cliqueflow.__main__ import listed, main

    (tmp_path / "raw").mkdir()
    lines = [{"id": "1", "lang": "en", "user": user(1, "u1", 1),
              "retweeted_status": {"id": "p", "user": user(2, "u2", 2)}}]
    (tmp_path / "raw" / "a.json").write_text("\n".join(json.dumps(x) for x in lines))
    (tmp_path / "prelabelled").mkdir()
    (tmp_path / "prelabelled" / "s.json").write_text('{"id": "2", "label": "Trump", "prelabelled": true}\n')
    main(["all", "--root", str(tmp_path), "--keep-sinks", "--communities", "Trump"], spark=spark)
    lab = {r["id"]: r["label"] for r in files.read_stage(spark, str(tmp_path / "labelled")).collect()}
    assert lab == {"1": "Trump", "2": "Trump"}
    assert listed("preset:politics") == "politics" and listed("a,,b") == ["a", "b"] and listed(None) is None
    with pytest.raises(SystemExit):
        main(["upload", "--root", str(tmp_path)], spark=spark)
