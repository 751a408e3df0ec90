"""Propagation equals a brute-force Python model of the round on random graphs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cliqueflow.operators import frontier
from cliqueflow.operators import propagation as P
from cliqueflow.plans import catalog
from cliqueflow.sources.social import SocialTables
from conftest import edges, vertices

COMMS = ["A", "B"]


def brute_round(verts, es, comms, keep_sinks):
    """verts: id -> (label, locked); es: (src, dst, weight) list."""
    scores = {}
    for s, d, w in es:
        if s in verts and d in verts:
            lab, lock = verts[d]
            scores.setdefault(s, {}).setdefault(lab, 0)
            scores[s][lab] += 2 * w if lock else w
    out = {}
    for v, (lab, lock) in verts.items():
        if v not in scores:
            if not keep_sinks:
                continue
            new = lab
        elif lock:
            new = lab
        else:
            best = max(scores[v].values())
            new = min(k for k, sc in scores[v].items() if sc == best)
        out[v] = (new, new in comms)
    return out


graphs = st.integers(min_value=2, max_value=7).flatmap(
    lambda n: st.tuples(
        st.just([f"v{i}" for i in range(n)]),
        st.lists(st.sampled_from(["", "A", "B", "C"]), min_size=n, max_size=n),
        st.lists(
            st.tuples(st.integers(0, n - 1), st.integers(0, n - 1), st.integers(1, 12)),
            min_size=1, max_size=14, unique_by=lambda e: (e[0], e[1])),
        st.booleans(),
        st.integers(1, 4),
    )
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(graphs)
def test_random_graphs_match_brute_force(spark, g):
    ids, seeds, raw_edges, keep_sinks, rounds = g
    verts = {v: ((s or v), bool(s)) for v, s in zip(ids, seeds)}  # seeded vertices are locked
    es = [(ids[a], ids[b], w) for a, b, w in raw_edges]
    spec = " ".join(f"{v}:{lab}{'*' if lock else ''}" for v, (lab, lock) in verts.items())
    want = verts
    for _ in range(rounds):
        want = brute_round(want, es, COMMS, keep_sinks)
    got = P.propagate(vertices(spark, spec), edges(spark, es), COMMS, iterations=rounds, keep_sinks=keep_sinks)
    assert {r["id"]: (r["label"], r["prelabelled"]) for r in got.collect()} == want


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(graphs)
def test_rounds_by_changes_match_brute_force(spark, g):
    ids, seeds, raw_edges, keep_sinks, rounds = g
    # every second seed is not locked at first, so locks are both lost and gained
    verts = {v: ((s or v), bool(s) and i % 2 == 0) for i, (v, s) in enumerate(zip(ids, seeds))}
    es = [(ids[a], ids[b], w) for a, b, w in raw_edges]
    v = spark.createDataFrame([(k, *x) for k, x in verts.items()], "id string, label string, prelabelled boolean")
    want, history = [verts], []
    for _ in range(rounds):
        want.append(brute_round(want[-1], es, COMMS, keep_sinks))
    got = frontier.propagate_changes(v, edges(spark, es), COMMS, rounds, keep_sinks, buckets=2, hot_threshold=1, history=history)
    assert {r["id"]: (r["label"], r["prelabelled"]) for r in got.collect()} == want[-1]
    for h, old, new in zip(history, want, want[1:]):
        moved = {k for k in old if old[k] != new.get(k)}
        assert (h["rows"], h["changed"]) == (len(new), len(moved))
        if h["round"] < rounds:
            assert h["edges"] == sum(d in moved for _, d, _ in es)


def test_fewer_edges_take_part_from_round_to_round(spark):
    t = SocialTables(spark, "/root/testdata/sf0.001")
    v, e = catalog.stored_graph(t)
    history = []
    frontier.propagate_changes(v, e, catalog.seed_communities(t), 10, keep_sinks=True, history=history)
    met = [h["edges"] for h in history]
    assert len(met) > 2 and met[0] > 0 and all(a >= b for a, b in zip(met[1:], met[2:])) and met[-1] < met[0]


def test_large_graphs_send_no_vertices_through_the_driver(spark):
    """A round of a graph above the bounds plans no broadcast of vertices or labels, and sorts no edges."""
    import contextlib
    import io

    v = spark.range(2000).selectExpr("concat('v', id) AS id", "concat('v', id) AS label", "false AS prelabelled")
    e = spark.range(4000).selectExpr("concat('v', id % 2000) AS src", "concat('v', (id * 7) % 2000) AS dst", "1L AS weight")
    layout = P.BucketedEdges(e, buckets=2)
    now, name, path = frontier._store(v, "id", 2, "lpa-vertices")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        frontier.choose(frontier.recounted(now, layout)).explain()
        frontier.next_vertices(now, frontier.recounted(now, layout), P.community_names(spark, COMMS), False).explain()
    for plan in buf.getvalue().split("== Physical Plan ==")[1:]:
        for line in plan.splitlines():
            assert "SortMergeJoin" not in line
            assert "BroadcastHashJoin" not in line or "name" in line or "salts" in line or "_community" in line or "dst" in line
        assert "ShuffledHashJoin [dst" in plan
    frontier.drop_bucketed(spark, name, path)
    layout.drop()
    assert P.BROADCAST_MAX_VERTICES <= 100_000  # ten rounds of three such tables are what the driver sees at most


def test_changes_alone_equal_whole_rounds(spark, monkeypatch):
    t = SocialTables(spark, "/root/testdata/sf0.001")
    v, e = catalog.stored_graph(t)
    want = {tuple(r) for r in P.propagate(v, e, catalog.seed_communities(t), 6).collect()}
    for dense in (0, 1 << 40):  # differences from the second round on; never
        monkeypatch.setattr(frontier, "DENSE", dense)
        assert {tuple(r) for r in frontier.propagate_changes(v, e, catalog.seed_communities(t), 6, buckets=3).collect()} == want
