"""Physical-plan shapes that matter at scale."""

import contextlib
import io

from pyspark.sql import Observation
from pyspark.sql import functions as F

from cliqueflow.operators import communities as comm
from cliqueflow.operators import frontier, graph, ingest, serving
from cliqueflow.operators import propagation as P
from cliqueflow.operators.layout import drop_bucketed
from cliqueflow.sources.social import SocialTables
from conftest import edges, vertices

SF = "/root/testdata/sf0.001"


def plan(df, mode="simple"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def before_first_exchange(text, marker):
    """True when ``marker`` shows up below (i.e. map side of) the first exchange in the plan text."""
    lines = text.splitlines()
    first = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    return any(marker in line for line in lines[first + 1:])


def test_topk_and_dedupe_limit_before_shuffle(spark):
    t = SocialTables(spark, SF)
    lab = spark.createDataFrame([("1", "ASIA")], "id string, label string")
    top = plan(comm.community_top_k(comm.community_members_join(lab, t.users, ["ASIA"]), 10))
    assert "WindowGroupLimit" in top and before_first_exchange(top, "Partial")
    users = plan(ingest.clean_users(t.tweets))
    assert before_first_exchange(users, "WindowGroupLimit")
    tl = plan(serving.user_timeline(t.event_posts, 5))
    assert before_first_exchange(tl, "WindowGroupLimit")


def test_profiles_of_every_role_need_one_join(spark):
    t = SocialTables(spark, SF)
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(ingest.dedupe_users(ingest.with_profiles(ingest.user_ids(t.tweet_ids), t.users, spread_nulls=False)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    # posts with orders, ids with profiles; ids are made unique map-side before they move
    assert text.count("SortMergeJoin") == 2 and text.count("Exchange hashpartitioning") == 4, text
    assert "SortAggregate" not in text and text.count("HashAggregate(keys=[id") == 2


def test_aggregates_are_partial_before_shuffle(spark):
    t = SocialTables(spark, SF)
    e = plan(graph.build_edges(ingest.gather_references(t.tweets)))
    assert before_first_exchange(e, "partial_count")
    v, ed = vertices(spark, "a b c"), edges(spark, [("a", "b", 1)])
    s = plan(P._step(v, ed, P.community_names(spark, ["X"]), False, False, False))
    assert "partial_sum" in s and "partial_min_by" in s


def test_vertex_broadcast_only_when_asked(spark):
    v, e = vertices(spark, "a b c"), edges(spark, [("a", "b", 1), ("b", "c", 2)])
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastExchange" not in plan(P._step(v, e, P.community_names(spark, ["X"]), False, False, False))
        assert "BroadcastExchange" in plan(P._step(v, e, P.community_names(spark, ["X"]), False, True, False))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_scans_prune_columns_and_push_filters(spark):
    t = SocialTables(spark, SF)
    text = plan(graph.build_edges(ingest.gather_references(t.tweets)), "formatted")
    assert "l_comment" not in text and "l_extendedprice" not in text
    assert "PushedFilters: [IsNotNull(l_orderkey)" in text


def test_no_python_evaluation_in_operators(spark):
    t = SocialTables(spark, SF)
    v, e = vertices(spark, "a b"), edges(spark, [("a", "b", 1)])
    for df in (ingest.clean_users(t.tweets), P.lpa_step(v, e, ["X"]),
               serving.reach_by_community(serving.retweet_events(t.tweets), v.select("id", "label"))):
        text = plan(df)
        assert "EvalPython" not in text and "PythonUDF" not in text


def test_stored_edges_are_range_clustered(spark):
    e = edges(spark, [("a", "b", 1), ("a", "c", 2), ("b", "c", 1)])
    text = plan(P.cluster_edges(e))
    assert "rangepartitioning(src" in text and "dst" in text


def test_rounds_by_changes_shuffle_changes_only(spark):
    v, e = vertices(spark, "a b c:X*"), edges(spark, [("a", "b", 1), ("b", "c", 2), ("c", "a", 1)])
    layout = P.BucketedEdges(e, 3, 1)
    names = F.broadcast(P.community_names(spark, ["X"]))  # as its size would have it, but for the setting below
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    now, *v_table = frontier._store(v, "id", 3, "plan-vertices")
    scored = P.lpa_associations(now, layout).selectExpr("src", "label", "weight AS score", "1L AS n")
    scores, *s_table = frontier._store(scored, "src", 3, "plan-scores")
    try:
        after = frontier.next_vertices(now, scores, names, False)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        # group-bys, the join back and the write need no exchange
        text = plan(after.repartition(3, "id"))
        assert "Exchange hashpartitioning" not in text and text.count("Bucketed: true") == 2, text
        text = plan(frontier.folded(scores, now, False).repartition(3, "src"))
        assert "Exchange" not in text, text
        # the edges stay where they are: changed vertices go to them, summed differences to the sources
        moved = frontier.differences(after, layout, Observation())
        below = plan(moved).split("SortMergeJoin")
        assert "partial_sum" in below[0] and "cliqueflow_lpa_edges" in plan(moved)
        edge_side = plan(moved)[plan(moved).index("cliqueflow_lpa_edges"):]
        assert "Bucketed: true" in edge_side.splitlines()[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
        layout.drop()
        for table in (v_table, s_table):
            drop_bucketed(spark, *table)


def test_orders_and_users_are_not_broadcast(spark, tmp_path):
    """Tables with a row for each order or user are shuffled, however few bytes they are stored in."""
    tables = {
        "customer": "1L AS c_custkey, 'n' AS c_name, 1 AS c_nationkey, 1.0D AS c_acctbal, 's' AS c_mktsegment",
        "orders": "1L AS o_orderkey, 1L AS o_custkey, timestamp '2020-01-01' AS o_orderdate",
        "lineitem": "1L AS l_orderkey, 1L AS l_partkey, 1L AS l_suppkey, 'O' AS l_linestatus, 'R' AS l_returnflag",
    }
    for name, row in tables.items():
        spark.sql(f"SELECT {row}").write.parquet(f"{tmp_path}/{name}.parquet")
    t = SocialTables(spark, str(tmp_path))
    for df in (t.posts, graph.build_edges(ingest.gather_references(t.tweet_ids))):
        text = plan(df)
        assert "SortMergeJoin" in text and "Broadcast" not in text, text
    lab = spark.createDataFrame([("1", "X"), ("2", "X"), ("1", None)], "id string, label string")
    members = comm.community_members_join(lab, t.users, ["X"])
    assert "SortMergeJoin" in plan(members), plan(members)
    assert [tuple(r) for r in members.collect()] == [("1", "X", "n", 1)]


def test_rounds_broadcast_no_short_list_of_names(spark, monkeypatch):
    v, e = vertices(spark, "a b c:X*"), edges(spark, [("a", "b", 1), ("b", "c", 2), ("c", "a", 1)])
    names = P.community_names(spark, ["X", "Y"])
    listed = P.short_list(names)
    assert sorted(listed) == ["X", "Y"] and P.short_list(P.community_names(spark, None)) == []
    one_null = spark.createDataFrame([("1", "X"), ("2", "x"), ("3", None)], "id string, label string")
    for few in (listed, names):
        assert [r["prelabelled"] for r in P.with_lock(one_null, few).orderBy("id").collect()] == [True, False, False]
    assert [r["prelabelled"] for r in P.with_lock(one_null, []).collect()] == [False] * 3
    assert "Join" not in plan(P.with_lock(one_null, listed))
    seen, whole = [], P.with_lock
    monkeypatch.setattr(P, "with_lock", lambda df, n: seen.append(n) or whole(df, n))
    monkeypatch.setattr(frontier, "with_lock", P.with_lock)
    want = sorted(P.propagate(v, e, ["X"], 2).collect())
    assert sorted(P.propagate(v, e, ["X"], 2, broadcast_max_vertices=0).collect()) == want
    assert seen and all(n == ["X"] for n in seen)
    # too many names, or a long one, are joined as before, with the same result
    for limit in ("LISTED_NAMES", "LISTED_CHARS"):
        with monkeypatch.context() as m:
            m.setattr(P, limit, 0)
            assert P.short_list(names) is names
            assert sorted(P.propagate(v, e, ["X"], 2).collect()) == want
            assert sorted(P.propagate(v, e, ["X"], 2, broadcast_max_vertices=0).collect()) == want
