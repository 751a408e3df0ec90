"""Community summaries: membership, size, leading members by followers and by PageRank."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, drop_path, materialize, path_bytes
from .layout import SaltedLayout, Salts, bucketed_copy, drop_bucketed
from .propagation import BROADCAST_MAX_BYTES, BROADCAST_MAX_VERTICES, Communities, community_names, propagation_edges


def community_members_join(labelled: DataFrame, users: DataFrame, communities: Communities) -> DataFrame:
    """(id, label, screen_name, followers_count) for labelled users of the listed communities.

    Labelled ids without a user row are not members (inner join). Stored ids and
    profiles look smaller to the planner than they are: neither is to be broadcast.
    """
    names = community_names(labelled.sparkSession, communities)
    lab = labelled.select("id", "label").join(names, F.col("label") == F.col("name"), "left_semi")
    return lab.join(users.select("id", "screen_name", "followers_count").hint("merge"), "id")


def community_size(members: DataFrame) -> DataFrame:
    """(name, size): member count per community; an empty community has no row."""
    return members.groupBy(F.col("label").alias("name")).agg(F.count(F.lit(1)).cast("int").alias("size"))


def community_top_k(members: DataFrame, k: int = 10) -> DataFrame:
    """(name, position, id, screen_name, followers_count): the ``k`` most-followed members.

    Followers high to low with unknown counts last, then screen name, then id.
    ``row_number() <= k`` is planned with a partial group limit ahead of the
    shuffle, so a community holding most users ships ``k`` rows per map task.
    """
    w = Window.partitionBy("label").orderBy(
        F.col("followers_count").desc_nulls_last(), F.col("screen_name").asc_nulls_last(), F.col("id").asc()
    )
    return (
        members.withColumn("position", F.row_number().over(w))
        .filter(F.col("position") <= k)
        .select(F.col("label").alias("name"), "position", "id", "screen_name", "followers_count")
    )


def summarise_communities(
    labelled: DataFrame, users: DataFrame, communities: Communities, k: int = 10
) -> DataFrame:
    """The communities table: (name, influencers, size), as in ``COMMUNITY_SCHEMA``.

    One join, stored once under the shared folder (sizes and the top-k read
    it twice; Spark would otherwise run the join once per branch), then two
    group-bys for all communities at once. The influencer list is ordered by
    rank and holds at most ``k`` names.
    """
    members = cut_lineage(community_members_join(labelled, users, communities), "community-members")
    top = (
        community_top_k(members, k)
        .filter(F.col("screen_name").isNotNull())
        .groupBy("name")
        .agg(F.array_sort(F.collect_list(F.struct("position", "screen_name"))).alias("ranked"))
        .select("name", F.transform("ranked", lambda r: r["screen_name"]).alias("influencers"))
    )
    out = community_size(members).join(top, "name", "left").select(
        "name", F.coalesce("influencers", F.array().cast("array<string>")).alias("influencers"), "size"
    )
    return out.select("name", "influencers", F.col("size").cast("int").alias("size"))


def community_pagerank(
    labelled: DataFrame,
    edges: DataFrame,
    communities: Communities,
    iterations: int = 5,
    damping: float = 0.85,
    tolerance: float | None = None,
    broadcast_max_vertices: int = BROADCAST_MAX_VERTICES,
    buckets: int | None = None,
    hot_threshold: int | None = None,
    history: list[float] | None = None,
) -> DataFrame:
    """(community, id, rank): weighted PageRank inside each community.

    Only edges with both ends in the same community count; direction is
    ``src -> dst`` (a retweeter endorses the author), each edge weighted by
    its count over the source's in-community out-weight. A vertex with no
    in-community out-edge spreads its rank evenly over its community. Ranks
    of a community sum to 1.

    With ``tolerance`` the rounds end as soon as the absolute changes of all
    ranks add up to no more than it (so those of each community do, too);
    ``iterations`` bounds them. The sum is observed in the write of a round and
    added to ``history``, if that is given.

    Members are broadcast to the edges while there are at most
    ``broadcast_max_vertices`` of them. Above that the edges meet both ends'
    communities in salted joins, those inside a community are stored in a salted
    bucketed layout, ranks are stored bucketed on ``id``, and a round shuffles
    only ranks and partially summed inflows.
    """
    spark = labelled.sparkSession
    names = community_names(spark, communities)
    few = names.count() <= BROADCAST_MAX_VERTICES  # what has a row for each community is as small

    def by_id(df: DataFrame) -> DataFrame:
        """A row for each vertex: a bucket's share is hashed in its task, and none passes the driver."""
        return df if small else df.hint("shuffle_hash")

    def constants(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if few else df

    counted = Observation("members")
    own = labelled.select("id", F.col("label").alias("community")).join(names, F.col("community") == F.col("name"), "left_semi")
    members, members_path = materialize(own.observe(counted, F.count(F.lit(1)).alias("n")), "pagerank-members")
    src_m = members.select(F.col("id").alias("src"), "community")
    dst_m = members.select(F.col("id").alias("dst"), F.col("community").alias("dst_community"))
    links = propagation_edges(edges).withColumn("weight", F.col("weight").cast("double"))
    small = counted.get["n"] <= broadcast_max_vertices and path_bytes(spark, members_path) <= BROADCAST_MAX_BYTES
    same = F.col("community") == F.col("dst_community")
    if small:
        both = links.join(F.broadcast(src_m), "src").join(F.broadcast(dst_m), "dst").filter(same)
        # range-clustered on (dst, src): a round's partial inflow sums fold a destination's edges
        inner, inner_path = materialize(both.select("src", "dst", "weight").repartitionByRange("dst", "src"), "pagerank-edges")
    else:
        # one job takes the edges to the communities of both ends; only in-community ones are stored
        into = Salts(links, "dst", "src", buckets, hot_threshold, tag="pagerank-in")
        outof = Salts(links, "src", "dst", into.buckets, into.threshold, tag="pagerank-out")
        ended = into.meet(into.dealt(links), dst_m, "dst").drop("salt")
        own_src = src_m.withColumnRenamed("community", "dst_community")
        layout = SaltedLayout.of(outof.meet(outof.dealt(ended), own_src, "src", ("dst_community",), "left_semi"), outof)
        into.drop()

    def meet(side: DataFrame) -> DataFrame:
        """In-community edges with what ``side`` (src, community, ...) says of their source."""
        return inner.join(F.broadcast(side), "src") if small else layout.join(side, "src").filter(same)

    def store(rows: DataFrame, tag: str) -> tuple[DataFrame, Callable[[], None]]:
        if small:
            table, path = materialize(rows, tag)
            return table, lambda: drop_path(spark, path)
        table, name, path = bucketed_copy(rows, "id", layout.buckets, tag)
        return table, lambda: drop_bucketed(spark, name, path)

    out_weight = meet(src_m).groupBy(F.col("src").alias("id")).agg(F.sum("weight").alias("out_weight"))
    sizes = members.groupBy("community").agg(F.count(F.lit(1)).cast("double").alias("n"))
    start = members.join(constants(sizes), "community").join(by_id(out_weight), "id", "left")
    ranks, drop = store(start.select("id", "community", "n", "out_weight", (F.lit(1.0) / F.col("n")).alias("rank")), "pagerank-round")
    for _ in range(iterations):
        shares = ranks.filter("out_weight is not null")
        shares = shares.select(F.col("id").alias("src"), "community", (F.col("rank") / F.col("out_weight")).alias("share"))
        inflow = meet(shares).groupBy(F.col("dst").alias("id")).agg(F.sum(F.col("share") * F.col("weight")).alias("inflow"))
        sink_mass = ranks.filter("out_weight is null").groupBy("community").agg(F.sum("rank").alias("sink_mass"))
        spread = F.coalesce("inflow", F.lit(0.0)) + F.coalesce("sink_mass", F.lit(0.0)) / F.col("n")
        nxt = (
            ranks.withColumnRenamed("rank", "old_rank")
            .join(by_id(inflow), "id", "left")
            .join(constants(sink_mass), "community", "left")
            .withColumn("rank", (1.0 - damping) / F.col("n") + damping * spread)
        )
        seen = Observation("pagerank-round")
        nxt = nxt.observe(seen, F.coalesce(F.sum(F.abs(F.col("rank") - F.col("old_rank"))), F.lit(0.0)).alias("change"))
        new_ranks, new_drop = store(nxt.select("id", "community", "n", "out_weight", "rank"), "pagerank-round")
        drop()
        ranks, drop = new_ranks, new_drop
        change = seen.get["change"]
        if history is not None:
            history.append(change)
        if tolerance is not None and change <= tolerance:
            break
    if small:
        drop_path(spark, inner_path)
        out = ranks
    else:
        out = cut_lineage(ranks, "pageranks")
        drop()
        layout.drop()
    drop_path(spark, members_path)
    return out.select("community", "id", "rank")


def relative_ranks(ranks: DataFrame) -> DataFrame:
    """Ranks as multiples of their community's mean rank, to nine places: they do not shrink as communities grow."""
    sizes = ranks.groupBy("community").agg(F.count(F.lit(1)).alias("n"))
    return ranks.join(sizes, "community").select("community", "id", F.round(F.col("rank") * F.col("n"), 9).alias("rank"))


def pagerank_leaders(ranks: DataFrame, users: DataFrame, k: int = 10) -> DataFrame:
    """(name, position, id, screen_name, rank): the ``k`` highest-ranked members per community."""
    w = Window.partitionBy("community").orderBy(F.col("rank").desc(), F.col("id").asc())
    return (
        ranks.withColumn("position", F.row_number().over(w))
        .filter(F.col("position") <= k)
        .join(users.select("id", "screen_name"), "id", "left")
        .select(F.col("community").alias("name"), "position", "id", "screen_name", "rank")
    )
