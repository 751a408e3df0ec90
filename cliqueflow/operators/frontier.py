"""Label propagation by changes, for graphs whose vertices are too many to broadcast.

As long as more than one vertex in ``DENSE`` changes, a round sums the shares of
all edges anew: they meet the vertices in the buckets of their destination and
are shuffled once, by source. Differences would be twice as many rows, and
appended ones are read again in every later round.

From then on there are three stored tables, all in the same number of buckets,
so that no round shuffles more than what changed in the round before it:

* the edges, bucketed on their destination (hot ones salted), written once;
* the scores (src, label, score, n): per source and label the summed weight
  and the number of out-edges to vertices of that label, bucketed on src. A
  round appends the differences that changed vertices make for the sources
  that point at them, and nothing else;
* the vertices of the round, bucketed on id.

Such a round sums the scores of each source (no exchange: they lie in its bucket),
chooses the best label, joins the vertices (no exchange either) and writes the
next vertices. Those whose label or lock changed, or that left, meet the edges
that point at them; each such edge takes its old share from the source's score
and adds the new one. The sum of ``n`` over a source is its survival counter:
at 0 no out-edge leads to a vertex that is left. The number of edges that take
part is observed in the write, and it falls as labels settle.

When the appended differences outgrow the scores they are folded: a source
that has left is dropped, and one that is locked, which keeps its label for
good, keeps its counter only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.columns import locked_weight
from ..session import materialize
from .layout import bucketed_name, drop_bucketed, write_bucketed
from .propagation import BucketedEdges, Communities, community_names, lpa_associations, propagation_edges, short_list, with_lock

#: A round sums all edges anew while more than one in so many vertices changed in the round before it.
DENSE = 8
SCORES = ["src", "label", "score", "n"]


def summed(scores: DataFrame) -> DataFrame:
    """One row for each source and label."""
    return scores.groupBy("src", "label").agg(F.sum("score").alias("score"), F.sum("n").alias("n"))


def choose(scores: DataFrame) -> DataFrame:
    """(src, best, left): the best label among those that an out-edge leads to, and the survival counter."""
    order = F.struct((F.col("n") <= 0).alias("gone"), (-F.col("score")).alias("neg_score"), F.col("label"))
    return summed(scores).groupBy("src").agg(F.min_by("label", order).alias("best"), F.sum("n").alias("left"))


def next_vertices(vertices: DataFrame, scores: DataFrame, names: DataFrame | list[str], keep_sinks: bool) -> DataFrame:
    """All vertices after a round: id, label, prelabelled, old_label, old_lock, alive."""
    old = vertices.select("id", F.col("label").alias("old_label"), F.col("prelabelled").alias("old_lock"))
    # a bucket's vertices are hashed where they lie: neither sorted nor sent through the driver
    joined = old.join(choose(scores).hint("shuffle_hash"), F.col("id") == F.col("src"), "left")
    seen = F.coalesce(F.col("left") > 0, F.lit(False))
    label = F.when(F.col("old_lock") | ~seen, F.col("old_label")).otherwise(F.coalesce("best", "old_label"))
    alive = F.lit(True) if keep_sinks else seen
    return with_lock(joined.select("id", label.alias("label"), "old_label", "old_lock", alive.alias("alive")), names)


def changed() -> F.Column:
    moved = ~F.col("label").eqNullSafe(F.col("old_label")) | (F.col("prelabelled") != F.col("old_lock"))
    return ~F.col("alive") | moved


def recounted(vertices: DataFrame, edges: BucketedEdges) -> DataFrame:
    """The scores (not summed) that all edges to ``vertices`` make, in buckets by source."""
    score, n = F.col("weight").cast("long").alias("score"), F.lit(1).cast("long").alias("n")
    return lpa_associations(vertices, edges).select("src", "label", score, n).repartition(edges.buckets, "src")


def differences(vertices: DataFrame, edges: BucketedEdges, obs: Observation) -> DataFrame:
    """What the changed vertices of a round make for the scores of the sources that point at them.

    ``obs`` gets ``edges``, those that take part, and ``n``, the rows made.
    """
    met = edges.join(vertices.filter(changed()), "id")
    share = F.col("weight").cast("long")
    was = F.struct(F.col("old_label").alias("label"), (-locked_weight(share, "old_lock")).alias("score"), F.lit(-1).cast("long").alias("n"))
    now = F.struct(F.col("label"), locked_weight(share, "prelabelled").alias("score"), F.lit(1).cast("long").alias("n"))
    both = F.when(F.col("alive"), F.array(was, now)).otherwise(F.array(was))
    rows = met.select("src", F.posexplode(both).alias("nth", "d")).select("src", "d.*", F.when(F.col("nth") == 0, 1).alias("edge"))
    sums = rows.groupBy("src", "label").agg(*[F.sum(c).alias(c) for c in ("score", "n", "edge")])
    differs = (F.col("score") != 0) | (F.col("n") != 0)
    # observed right above the aggregate, where the plan of an empty one still holds it
    seen = sums.observe(obs, F.coalesce(F.sum("edge"), F.lit(0)).alias("edges"), F.count(F.when(differs, 1)).alias("n"))
    return seen.filter(differs).select(*SCORES)


def folded(scores: DataFrame, vertices: DataFrame, keep_sinks: bool) -> DataFrame:
    """The scores of ``vertices``; of locked ones the counter only, and that only where sinks leave."""
    own = vertices.select("id", "prelabelled")
    if keep_sinks:
        own = own.filter(~F.col("prelabelled"))
    met = scores.join(own, F.col("src") == F.col("id"))
    label = F.when(~F.col("prelabelled"), F.col("label"))
    score = F.when(~F.col("prelabelled"), F.col("score")).otherwise(F.lit(0))
    return summed(met.select("src", label.alias("label"), score.alias("score"), "n")).filter("n > 0")


def _store(rows: DataFrame, key: str, buckets: int, tag: str, obs: Observation | None = None) -> tuple[DataFrame, str, str]:
    name, path = bucketed_name(rows.sparkSession, tag)
    write_bucketed(rows.observe(obs, F.count(F.lit(1)).alias("n")) if obs else rows, key, buckets, name, path)
    return rows.sparkSession.table(name), name, path


def propagate_changes(
    vertices: DataFrame,
    edges: DataFrame,
    communities: Communities = None,
    iterations: int = 10,
    keep_sinks: bool = False,
    buckets: int | None = None,
    hot_threshold: int | None = None,
    history: list[dict] | None = None,
) -> DataFrame:
    """``propagation.propagate`` by changes: (id, label, prelabelled), stored.

    ``history``, if given, gets a row for each round: round, rows, changed, edges
    (those that the round's changes met; 0 in the last one).
    """
    spark = vertices.sparkSession
    layout = BucketedEdges(propagation_edges(edges), buckets, hot_threshold)
    buckets = layout.buckets
    names = short_list(community_names(spark, communities))
    first = vertices.select("id", "label", F.coalesce("prelabelled", F.lit(False)).alias("prelabelled"))
    now, *stored = _store(first, "id", buckets, "lpa-vertices")
    scores, kept, rows, added = recounted(now, layout), None, 0, 0

    for i in range(1, iterations + 1):
        seen = Observation("lpa-round")
        stats = [F.count(F.when(F.col("alive"), 1)).alias("rows"), F.count(F.when(changed(), 1)).alias("changed")]
        after, *nxt = _store(next_vertices(now, scores, names, keep_sinks).observe(seen, *stats), "id", buckets, "lpa-vertices")
        drop_bucketed(spark, *stored)
        stored, told = nxt, seen.get
        now = after.filter("alive").select("id", "label", "prelabelled")
        met, more = 0, told["changed"] and i < iterations
        if more and kept:
            seen = Observation("lpa-differences")
            write_bucketed(differences(after, layout, seen), "src", buckets, *kept)
            spark.catalog.refreshTable(kept[0])
            scores = spark.table(kept[0])
            met, added = seen.get["edges"], added + seen.get["n"]
            if added > rows:
                counted = Observation("lpa-scores")
                scores, *fold = _store(folded(scores, now, keep_sinks), "src", buckets, "lpa-scores", counted)
                drop_bucketed(spark, *kept)
                kept, rows, added = fold, counted.get["n"], 0
        elif more:
            scores = recounted(now, layout)
            if told["changed"] * DENSE <= told["rows"] and i + 1 < iterations:
                counted = Observation("lpa-scores")
                scores, *kept = _store(summed(scores), "src", buckets, "lpa-scores", counted)
                rows = counted.get["n"]
            if history is not None:
                met = layout.join(after.filter(changed()).select("id"), "id").count()
        if history is not None:
            history.append({"round": i, "rows": told["rows"], "changed": told["changed"], "edges": met})
        if not told["changed"]:
            break
    out, _ = materialize(now, "lpa-result")
    for table in filter(None, (stored, kept)):
        drop_bucketed(spark, *table)
    layout.drop()
    return out
