"""Semi-supervised label propagation over the weighted reference graph.

One round, synchronous over all vertices:

1. every edge ``src -> dst`` picks up the label and lock of its destination;
   the weight counts double when the destination is locked;
2. per source, weights are summed per label (partial aggregation map-side);
3. the label with the highest sum wins, ties to the smallest label;
4. a locked vertex keeps its label; the lock is then re-evaluated as
   "label is a community name".

By default a vertex with no out-edge to a surviving vertex leaves the graph
(``keep_sinks=False``); with ``keep_sinks=True`` it stays with its label.

A round is a join of edges with vertex labels (a broadcast while the vertex
table is proven small; above that only changes move, see ``frontier``), two
partially aggregated group-bys, and a join back on the vertex id. ``propagate`` writes each round
to the shared folder, so lineage never grows and a lost executor costs at
most one round.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import best_label, locked_weight
from ..schemas import PRESETS, VERTEX_SCHEMA
from ..session import cut_lineage, drop_path, materialize, path_bytes, scratch_path
from .layout import SaltedLayout

# Vertex tables up to this many rows, and up to this many stored (parquet)
# bytes, are broadcast to the edge partitions; above either bound the edges
# go into a salted bucketed layout. A broadcast table passes the driver, and
# each round broadcasts three, so the bounds are small.
BROADCAST_MAX_VERTICES = 50_000
BROADCAST_MAX_BYTES = 4 * 1024 * 1024

# Communities up to this many, of up to this many characters each, are written
# into the plan of a round; others are joined, which broadcasts them each round.
LISTED_NAMES = 100
LISTED_CHARS = 1000

Communities = DataFrame | Iterable[str] | str | None


def community_names(spark: SparkSession, communities: Communities) -> DataFrame:
    """(name): the communities, each once and never null; any number of them.

    A DataFrame gives its ``name`` (or first) column and is stored, a text
    names one of the lists of ``schemas.PRESETS``. Either way its size is known
    to the planner, which broadcasts it as long as it is small.
    """
    if isinstance(communities, DataFrame):
        col = "name" if "name" in communities.columns else communities.columns[0]
        named = communities.select(F.col(col).cast("string").alias("name")).filter(F.col("name").isNotNull())
        return cut_lineage(named.distinct(), "communities")
    if isinstance(communities, str):
        if communities not in PRESETS:
            raise ValueError(f"unknown list of communities {communities!r}; known: {', '.join(PRESETS)}")
        communities = PRESETS[communities]
    names = dict.fromkeys(str(c) for c in communities or ())
    return spark.createDataFrame(pa.table({"name": pa.array(names, pa.string())}))


def short_list(names: DataFrame) -> DataFrame | list[str]:
    """The rows of ``community_names``, if they are few and short; else ``names`` as it is."""
    short = F.when(F.length("name") <= LISTED_CHARS, F.col("name")).alias("name")
    found = [r["name"] for r in names.select(short).limit(LISTED_NAMES + 1).collect()]
    return names if len(found) > LISTED_NAMES or None in found else found


def with_lock(labelled: DataFrame, names: DataFrame | list[str]) -> DataFrame:
    """``labelled`` with ``prelabelled``: its label is a community's name (never null)."""
    if isinstance(names, list):
        return labelled.withColumn("prelabelled", F.coalesce(F.col("label").isin(names), F.lit(False)))
    listed = names.select(F.col("name").alias("_community"))
    met = labelled.join(listed, F.col("label") == F.col("_community"), "left")
    return met.withColumn("prelabelled", F.col("_community").isNotNull()).drop("_community")


def propagation_edges(edges: DataFrame) -> DataFrame:
    """Edges that can carry a label: both ends known."""
    return edges.select("src", "dst", "weight").filter(F.col("src").isNotNull() & F.col("dst").isNotNull())


def cluster_edges(edges: DataFrame) -> DataFrame:
    """Edges range-partitioned on (src, dst), for storing.

    Read back, each task then holds whole runs of a source's edges, so the
    map-side partial sum per (src, label) folds them into a few rows before
    the shuffle (hash-partitioned edges leave it nothing to fold). Range
    bounds on (src, dst) split a source with a huge out-degree across tasks.
    """
    return propagation_edges(edges).repartitionByRange("src", "dst")


class BucketedEdges(SaltedLayout):
    """Edges stored once, bucketed on ``dst`` (hot destinations salted by ``src``).

    Each round only the vertex labels are shuffled into the buckets; a
    widely referenced author is spread over several buckets.
    """

    def __init__(self, edges: DataFrame, buckets: int | None = None, threshold: int | None = None):
        super().__init__(propagation_edges(edges), "dst", "src", buckets, threshold, tag="lpa-edges")

    def associations(self, vertices: DataFrame) -> DataFrame:
        dst_side = vertices.select(F.col("id").alias("dst"), "label", "prelabelled")
        return self.join(dst_side, "dst").select(
            "src", "dst", locked_weight("weight", "prelabelled").alias("weight"), "label"
        )


EdgeInput = DataFrame | BucketedEdges


def lpa_associations(vertices: DataFrame, edges: EdgeInput, broadcast_vertices: bool = False) -> DataFrame:
    """(src, dst, weight, label): each edge with its destination's label; locked destinations count double."""
    if isinstance(edges, BucketedEdges):
        return edges.associations(vertices)
    dst_side = vertices.select(F.col("id").alias("dst"), "label", "prelabelled")
    if broadcast_vertices:
        dst_side = F.broadcast(dst_side)
    return propagation_edges(edges).join(dst_side, "dst").select(
        "src", "dst", locked_weight("weight", "prelabelled").alias("weight"), "label"
    )


def lpa_outgoing(vertices: DataFrame, edges: EdgeInput, broadcast_vertices: bool = False) -> DataFrame:
    """What a vertex sees before it chooses: its own label and lock next to each outgoing (label, weight).

    One row per surviving out-edge (the relational form of the paired
    weight/label lists), so a vertex with millions of edges is never folded
    into one row.
    """
    out = lpa_associations(vertices, edges, broadcast_vertices).select(
        F.col("src").alias("id"), F.col("label").alias("out_label"), F.col("weight").alias("out_weight")
    )
    own = vertices.select("id", "label", "prelabelled")
    return out.join(own, "id").select("id", "label", "prelabelled", "out_label", "out_weight")


def lpa_scores(vertices: DataFrame, edges: EdgeInput, broadcast_vertices: bool = False) -> DataFrame:
    """(id, label, score): summed (lock-doubled) weight per source vertex and destination label."""
    return (
        lpa_associations(vertices, edges, broadcast_vertices)
        .groupBy(F.col("src").alias("id"), "label")
        .agg(F.sum("weight").alias("score"))
    )


def lpa_choose(scores: DataFrame) -> DataFrame:
    """(id, best): the best-scoring label per vertex."""
    return scores.groupBy("id").agg(best_label("label", "score").alias("best"))


def _step(
    vertices: DataFrame,
    edges: EdgeInput,
    names: DataFrame | list[str],
    keep_sinks: bool,
    broadcast_vertices: bool,
    track_changes: bool,
) -> DataFrame:
    best = lpa_choose(lpa_scores(vertices, edges, broadcast_vertices))
    if broadcast_vertices:
        # sources need not be vertices: only those that are stay, so the vertex count bounds what is broadcast
        best = F.broadcast(best.join(F.broadcast(vertices.select("id")), "id", "left_semi"))
    old = vertices.select(
        "id", F.col("label").alias("old_label"), F.coalesce("prelabelled", F.lit(False)).alias("old_lock")
    )
    joined = old.join(best, "id", "left" if keep_sinks else "inner")
    label = F.when(F.col("old_lock"), F.col("old_label")).otherwise(F.coalesce("best", "old_label"))
    out = with_lock(joined.select("id", label.alias("label"), "old_label", "old_lock"), names)
    cols = ["id", "label", "prelabelled"]
    if track_changes:
        changed = ~F.col("label").eqNullSafe(F.col("old_label")) | (F.col("prelabelled") != F.col("old_lock"))
        return out.select(*cols, changed.alias("changed"))
    return out.select(*cols)


def lpa_step(
    vertices: DataFrame,
    edges: DataFrame,
    communities: Communities = None,
    keep_sinks: bool = False,
    broadcast_vertices: bool = False,
) -> DataFrame:
    """One propagation round: (id, label, prelabelled)."""
    names = community_names(vertices.sparkSession, communities)
    return _step(vertices, edges, names, keep_sinks, broadcast_vertices, False)


def _write_counted(step: DataFrame, path: str) -> dict:
    """Write (id, label, prelabelled) to ``path``; the same job counts rows and changed rows."""
    obs = Observation("lpa-round")
    step.observe(
        obs,
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.col("changed").cast("long")), F.lit(0)).alias("changed"),
    ).select("id", "label", "prelabelled").write.mode("overwrite").parquet(path)
    return obs.get


def propagate(
    vertices: DataFrame,
    edges: DataFrame,
    communities: Communities = None,
    iterations: int = 10,
    keep_sinks: bool = False,
    stop_early: bool = True,
    broadcast_max_vertices: int = BROADCAST_MAX_VERTICES,
    materialize_edges: bool = True,
    edge_buckets: int | None = None,
    hot_threshold: int | None = None,
    keep_rounds: bool = False,
) -> DataFrame:
    """Run ``iterations`` rounds; returns (id, label, prelabelled).

    Up to ``broadcast_max_vertices`` vertices, the vertex labels are
    broadcast to the edges each round. Above it, only what changed moves: see
    ``frontier.propagate_changes``, which ``edge_buckets`` and
    ``hot_threshold`` are for.

    Each round is written to the shared folder and read back. The write also
    observes the row count and the number of changed rows (no extra job);
    only those two numbers reach the driver. When a round leaves every row
    as it was, later rounds would repeat it, so the loop stops there with the
    same result. Pass ``materialize_edges=False`` when ``edges`` is already a
    stored table.
    """
    spark = vertices.sparkSession
    names = community_names(spark, communities)
    v0 = vertices.select("id", "label", F.coalesce("prelabelled", F.lit(False)).alias("prelabelled"))
    current_path = scratch_path(spark, "lpa-round0")
    n_rows = _write_counted(v0.withColumn("changed", F.lit(False)), current_path)["n"]
    current = spark.read.schema(VERTEX_SCHEMA).parquet(current_path)

    edge_path = None
    if n_rows > broadcast_max_vertices or path_bytes(spark, current_path) > BROADCAST_MAX_BYTES:
        from .frontier import propagate_changes

        out = propagate_changes(current, edges, names, iterations, keep_sinks, edge_buckets, hot_threshold)
        drop_path(spark, current_path)
        return out
    edge_input = propagation_edges(edges)
    if materialize_edges:
        edge_input, edge_path = materialize(cluster_edges(edge_input), "lpa-edges")
    listed = short_list(names)

    for i in range(1, iterations + 1):
        step = _step(current, edge_input, listed, keep_sinks, True, True)
        nxt_path = scratch_path(spark, f"lpa-round{i}")
        stats = _write_counted(step, nxt_path)
        unchanged = stats["n"] == n_rows and stats["changed"] == 0
        if not keep_rounds:
            drop_path(spark, current_path)
        current, current_path, n_rows = spark.read.schema(VERTEX_SCHEMA).parquet(nxt_path), nxt_path, stats["n"]
        if stop_early and unchanged:
            break
    if not keep_rounds:
        if edge_path:
            drop_path(spark, edge_path)
    return current.select("id", "label", "prelabelled")


def labelled_output(vertices: DataFrame) -> DataFrame:
    """The stored result of propagation: (id, label)."""
    return vertices.drop("prelabelled").select("id", "label")
