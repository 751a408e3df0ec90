"""Label propagation on hand fixtures (H1-H4) and its invariants."""

import pytest
from pyspark.sql import functions as F

from cliqueflow.operators import propagation as P
from conftest import edges, rows, vertices

H1_V = "A:Trump* B:Biden* x y z"
H1_E = [("x", "A", 1), ("x", "B", 1), ("y", "x", 3), ("y", "A", 2), ("z", "y", 1)]
H1_C = ["Trump", "Biden"]


def labels(df):
    return {r["id"]: (r["label"], r["prelabelled"]) for r in df.collect()}


def run(spark, v, e, c, n, keep_sinks=False, stop_early=True):
    return P.propagate(vertices(spark, v), edges(spark, e), c, iterations=n, keep_sinks=keep_sinks,
                       stop_early=stop_early)


def test_h1_drop_sinks_round_by_round(spark):
    assert labels(run(spark, H1_V, H1_E, H1_C, 1)) == {
        "x": ("Biden", True), "y": ("Trump", True), "z": ("y", False)}
    assert labels(run(spark, H1_V, H1_E, H1_C, 2)) == {"y": ("Trump", True), "z": ("Trump", True)}
    assert labels(run(spark, H1_V, H1_E, H1_C, 3)) == {"z": ("Trump", True)}
    assert labels(run(spark, H1_V, H1_E, H1_C, 4)) == {}


def test_h1_keep_sinks(spark):
    assert labels(run(spark, H1_V, H1_E, H1_C, 1, keep_sinks=True)) == {
        "A": ("Trump", True), "B": ("Biden", True), "x": ("Biden", True), "y": ("Trump", True), "z": ("y", False)}
    stable = {"A": ("Trump", True), "B": ("Biden", True), "x": ("Biden", True), "y": ("Trump", True),
              "z": ("Trump", True)}
    assert labels(run(spark, H1_V, H1_E, H1_C, 2, keep_sinks=True)) == stable
    assert labels(run(spark, H1_V, H1_E, H1_C, 10, keep_sinks=True, stop_early=False)) == stable


def test_h2_weights_compare_as_numbers(spark):
    out = run(spark, "p q:a r:b", [("p", "q", 10), ("p", "r", 9), ("q", "p", 1), ("r", "p", 1)], ["Trump"], 1)
    assert labels(out) == {"p": ("a", False), "q": ("p", False), "r": ("p", False)}


def test_h3_scores_are_summed_per_label(spark):
    e = [("p", "q1", 3), ("p", "q2", 3), ("p", "r", 5)]
    assert labels(run(spark, "p q1:a q2:a r:b", e, ["Trump"], 1)) == {"p": ("a", False)}
    kept = labels(run(spark, "p q1:a q2:a r:b", e, ["Trump"], 1, keep_sinks=True))
    assert kept == {"p": ("a", False), "q1": ("a", False), "q2": ("a", False), "r": ("b", False)}


def test_h4_seed_outside_list_loses_lock(spark):
    e = [("S", "t", 1), ("t", "S", 1), ("t", "t", 5)]
    assert labels(run(spark, "S:Other* t", e, ["Trump"], 1)) == {"S": ("Other", False), "t": ("t", False)}
    assert labels(run(spark, "S:Other* t", e, ["Trump"], 2)) == {"S": ("t", False), "t": ("t", False)}


def test_step_matches_propagate_one_round(spark):
    v, e = vertices(spark, H1_V), edges(spark, H1_E)
    assert rows(P.lpa_step(v, e, H1_C)) == rows(P.propagate(v, e, H1_C, iterations=1))
    assert rows(P.lpa_step(v, e, H1_C, keep_sinks=True)) == rows(
        P.propagate(v, e, H1_C, iterations=1, keep_sinks=True))


def test_scores_and_associations(spark):
    v, e = vertices(spark, H1_V), edges(spark, H1_E)
    assert rows(P.lpa_associations(v, e)) == sorted([
        ("x", "A", 2, "Trump"), ("x", "B", 2, "Biden"), ("y", "x", 3, "x"), ("y", "A", 4, "Trump"),
        ("z", "y", 1, "y")])
    assert rows(P.lpa_scores(v, e)) == sorted([
        ("x", "Trump", 2), ("x", "Biden", 2), ("y", "x", 3), ("y", "Trump", 4), ("z", "y", 1)])
    assert rows(P.lpa_outgoing(v, e), "id", "out_label") == sorted([
        ("x", "Trump"), ("x", "Biden"), ("y", "x"), ("y", "Trump"), ("z", "y")])


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_result_does_not_depend_on_partitioning(spark, partitions):
    v, e = vertices(spark, H1_V), edges(spark, H1_E)
    base = rows(P.propagate(v, e, H1_C, iterations=3, keep_sinks=True))
    assert rows(P.propagate(v.repartition(partitions), e.repartition(partitions), H1_C, iterations=3,
                            keep_sinks=True)) == base


def test_broadcast_and_shuffle_plans_agree(spark):
    v, e = vertices(spark, H1_V), edges(spark, H1_E)
    a = P.propagate(v, e, H1_C, iterations=3, broadcast_max_vertices=0)
    b = P.propagate(v, e, H1_C, iterations=3, broadcast_max_vertices=10**9)
    assert rows(a) == rows(b)


def test_labels_come_from_ids_or_seeds_and_locks_hold(spark):
    from cliqueflow.plans import catalog
    from cliqueflow.sources.social import SocialTables

    t = SocialTables(spark, "/root/testdata/sf0.001")
    v, e = catalog.stored_graph(t)
    v0 = {r["id"]: (r["label"], r["prelabelled"]) for r in v.collect()}
    out = labels(P.propagate(v, e, catalog.seed_communities(t), iterations=4, keep_sinks=True))
    allowed = set(v0) | {lab for lab, _ in v0.values()}
    assert all(lab in allowed for lab, _ in out.values())
    for vid, (lab, locked) in v0.items():
        if locked:  # seeds carry community labels, so they stay locked with their label
            assert out[vid] == (lab, True)


def test_communities_are_a_relation(spark):
    comms = spark.createDataFrame([("Trump",), ("Trump",), ("Biden",), (None,)], "name string")
    assert rows(P.community_names(spark, comms)) == [("Biden",), ("Trump",)]
    assert rows(P.community_names(spark, None)) == []
    assert rows(P.community_names(spark, ["b", "a", "b"])) == [("a",), ("b",)]
    assert P.community_names(spark, "politics").count() == 17
    with pytest.raises(ValueError, match="unknown list"):
        P.community_names(spark, "nobody")


@pytest.mark.parametrize("limit", [P.BROADCAST_MAX_VERTICES, 0])
def test_twenty_thousand_communities(spark, limit):
    names = spark.range(20_000).selectExpr("concat('c', id) AS name")
    v = vertices(spark, "a:c19999* b:other* x")
    e = edges(spark, [("x", "a", 1), ("a", "b", 1), ("b", "a", 1)])
    out = P.propagate(v, e, names, iterations=2, broadcast_max_vertices=limit, edge_buckets=3)
    assert labels(out) == {"x": ("c19999", True), "a": ("c19999", True), "b": ("c19999", True)}


def test_labelled_output_drops_lock(spark):
    out = P.labelled_output(vertices(spark, H1_V))
    assert out.columns == ["id", "label"]
    assert rows(out)[0] == ("A", "Trump")


def test_bucketed_salted_layout_matches_broadcast(spark):
    v, e = vertices(spark, H1_V), edges(spark, H1_E)
    want = rows(P.propagate(v, e, H1_C, iterations=4, keep_sinks=True))
    # every destination with more than one in-edge is salted
    got = P.propagate(v, e, H1_C, iterations=4, keep_sinks=True, broadcast_max_vertices=0, edge_buckets=3,
                      hot_threshold=1)
    assert rows(got) == want


def test_bucketed_layout_on_driver_tables(spark):
    from cliqueflow.plans import catalog
    from cliqueflow.sources.social import SocialTables

    t = SocialTables(spark, "/root/testdata/sf0.001")
    v, e = catalog.stored_graph(t)
    comms = catalog.seed_communities(t)
    want = rows(P.propagate(v, e, comms, iterations=3, materialize_edges=False))
    got = P.propagate(v, e, comms, iterations=3, broadcast_max_vertices=0, edge_buckets=4, hot_threshold=5)
    assert rows(got) == want


def test_bucketed_layout_does_not_shuffle_edges(spark):
    import contextlib
    import io

    v, e = vertices(spark, H1_V), edges(spark, H1_E * 3)
    layout = P.BucketedEdges(e, buckets=4, threshold=2)
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert layout.hot.count() >= 1
        assoc = P.lpa_associations(v, layout)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            assoc.explain()
        text = buf.getvalue()
        scan = next(line for line in text.splitlines() if "cliqueflow_lpa_edges_" in line)
        assert "Bucketed: true" in scan, scan
        # the only hash exchange is on the vertex side
        assert text.count("Exchange hashpartitioning") == 1
        assert rows(assoc) == rows(P.lpa_associations(v, e))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
        layout.drop()
