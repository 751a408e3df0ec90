"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's tables through ``SocialTables`` and runs the
library operators over them whole. Outputs are scalar columns (arrays are
joined with ``,``, times formatted as text, ranks rounded) so they compare
value for value with the DuckDB oracle in ``oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import communities as comm
from ..operators import frontier, graph, ingest, links, propagation, serving
from ..schemas import Paths
from ..session import cut_lineage, distilled, scratch_path
from ..sources import files
from ..sources.social import SocialTables
from ..streaming.live_reach import read_live_reach, start_live_reach
from ..streaming.reach_log import ReachLog, start_reach_log
from .stages import run_stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

LPA_ROUNDS = 10
TOP_K = 10
PAGERANK_ROUNDS = 5
TIMELINE_N = 5


def query(fn: Callable[[SocialTables], DataFrame]) -> Callable[[SocialTables], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(SocialTables(spark, sf_dir))
    return fn


# ---------------------------------------------------------------- building blocks


def refs_of(t: SocialTables) -> DataFrame:
    return ingest.gather_references(t.tweet_ids, "en")


def seed_communities(t: SocialTables) -> DataFrame:
    return t.seeds.select(F.col("label").alias("name"))


def graph_of(t: SocialTables) -> tuple[DataFrame, DataFrame]:
    refs = refs_of(t)
    return graph.build_vertices(refs, t.seeds), graph.build_edges(refs)


def stored_graph(t: SocialTables) -> tuple[DataFrame, DataFrame]:
    """The graph as the ``make`` stage leaves it: edges stored once, vertex ids taken from them.

    The edges are not clustered yet: that is for rounds with broadcasts, large graphs deal them out otherwise.
    """
    edges = cut_lineage(propagation.propagation_edges(graph.build_edges(refs_of(t))), "edges")
    return graph.build_vertices(edges, t.seeds), edges


def labelled(t: SocialTables, rounds: int = LPA_ROUNDS, keep_sinks: bool = False) -> DataFrame:
    def run() -> DataFrame:
        vertices, edges = stored_graph(t)
        return propagation.propagate(vertices, edges, seed_communities(t), iterations=rounds, keep_sinks=keep_sinks)

    return distilled(t.spark, run, "labelled")


def members(t: SocialTables) -> DataFrame:
    return comm.community_members_join(labelled(t), t.users, seed_communities(t))


def summary(t: SocialTables) -> DataFrame:
    def run() -> DataFrame:
        return comm.summarise_communities(labelled(t), t.users, seed_communities(t), k=TOP_K)

    return distilled(t.spark, run, "communities")


def labelled_by_changes(t: SocialTables, keep_sinks: bool = False) -> DataFrame:
    def run() -> DataFrame:
        return frontier.propagate_changes(*stored_graph(t), seed_communities(t), LPA_ROUNDS, keep_sinks)

    return distilled(t.spark, run, "labelled")


def pageranks(t: SocialTables, **options) -> DataFrame:
    def run() -> DataFrame:
        vertices, edges = stored_graph(t)
        names = seed_communities(t)
        lab = propagation.propagate(vertices, edges, names, iterations=LPA_ROUNDS)
        return comm.community_pagerank(lab, edges, names, iterations=PAGERANK_ROUNDS, **options)

    return distilled(t.spark, run, "pageranks")


def text_list(c: str) -> F.Column:
    return F.array_join(F.col(c), ",").alias(c)


# ---------------------------------------------------------------- scans and cleaning


@query
def tweets_scan(t: SocialTables) -> DataFrame:
    """Raw JSON scan: the derived posts are written as JSON lines and read back with the fixed schema."""

    def run() -> DataFrame:
        path = scratch_path(t.spark, "tweets-json")
        files.write_tweets(t.tweets, path)
        return ingest.flatten_tweets(files.read_tweets(t.spark, path))

    return distilled(t.spark, run, "tweets")


@query
def tweeters(t: SocialTables) -> DataFrame:
    return ingest.tweeters(t.tweets)


@query
def quoted_users(t: SocialTables) -> DataFrame:
    return ingest.quoted_users(t.tweets)


@query
def retweeted_users(t: SocialTables) -> DataFrame:
    return ingest.retweeted_users(t.tweets)


@query
def all_users(t: SocialTables) -> DataFrame:
    """Every mention of a user; posts carry ids, and one join brings the profiles of all roles."""
    return ingest.with_profiles(ingest.all_users(t.tweet_ids), t.users)


@query
def unique_users(t: SocialTables) -> DataFrame:
    """Ids are made unique before they meet the profiles, so no key of the join is hot."""
    return ingest.dedupe_users(ingest.with_profiles(ingest.user_ids(t.tweet_ids), t.users, spread_nulls=False))


@query
def stages_users(t: SocialTables) -> DataFrame:
    """The users that the ``clean`` stage stores from raw JSON, whose posts carry the profiles themselves."""

    def run() -> DataFrame:
        paths = Paths(scratch_path(t.spark, "stages"))
        files.write_tweets(t.tweets, paths["input"])
        run_stage(t.spark, "clean", paths)
        return files.read_stage(t.spark, paths["users"])

    return distilled(t.spark, run, "stages-users")


@query
def references(t: SocialTables) -> DataFrame:
    return refs_of(t)


# ---------------------------------------------------------------- graph


@query
def edges_weighted(t: SocialTables) -> DataFrame:
    return graph.build_edges(refs_of(t))


@query
def vertices_distinct(t: SocialTables) -> DataFrame:
    return graph.vertex_ids(refs_of(t))


@query
def vertices_initial(t: SocialTables) -> DataFrame:
    return graph.initial_vertices(graph.vertex_ids(refs_of(t)))


@query
def vertices_seeded(t: SocialTables) -> DataFrame:
    return graph_of(t)[0]


# ---------------------------------------------------------------- propagation


@query
def lpa_associations(t: SocialTables) -> DataFrame:
    return propagation.lpa_associations(*graph_of(t))


@query
def lpa_outgoing(t: SocialTables) -> DataFrame:
    return propagation.lpa_outgoing(*graph_of(t))


@query
def lpa_scores(t: SocialTables) -> DataFrame:
    return propagation.lpa_scores(*graph_of(t))


@query
def lpa_step(t: SocialTables) -> DataFrame:
    return propagation.lpa_step(*graph_of(t), seed_communities(t))


@query
def lpa_step_keep_sinks(t: SocialTables) -> DataFrame:
    return propagation.lpa_step(*graph_of(t), seed_communities(t), keep_sinks=True)


@query
def lpa_run3(t: SocialTables) -> DataFrame:
    return labelled(t, 3)


@query
def lpa_run10(t: SocialTables) -> DataFrame:
    return labelled(t, 10)


@query
def lpa_run10_keep_sinks(t: SocialTables) -> DataFrame:
    return labelled(t, 10, keep_sinks=True)


@query
def lpa_run10_bucketed(t: SocialTables) -> DataFrame:
    """Ten rounds as large graphs run them: stored buckets, and only changes move."""
    return labelled_by_changes(t)


@query
def lpa_run10_keep_sinks_bucketed(t: SocialTables) -> DataFrame:
    return labelled_by_changes(t, keep_sinks=True)


@query
def labelled_output(t: SocialTables) -> DataFrame:
    """The stored stage table: written as parquet and read back."""
    path = scratch_path(t.spark, "labelled")
    files.write_stage(propagation.labelled_output(labelled(t)), path)
    return files.read_stage(t.spark, path)


# ---------------------------------------------------------------- communities


@query
def community_members_join(t: SocialTables) -> DataFrame:
    return members(t)


@query
def community_size(t: SocialTables) -> DataFrame:
    return comm.community_size(members(t))


@query
def community_top10(t: SocialTables) -> DataFrame:
    return comm.community_top_k(members(t), TOP_K)


@query
def communities(t: SocialTables) -> DataFrame:
    return summary(t).select("name", text_list("influencers"), "size")


@query
def community_pagerank(t: SocialTables) -> DataFrame:
    return pageranks(t).select("community", "id", F.round("rank", 6).alias("rank"))


@query
def pagerank_top10(t: SocialTables) -> DataFrame:
    """Influencers by PageRank: the ten highest ranks (to 6 places) per community, ties by id."""
    return comm.pagerank_leaders(pageranks(t).withColumn("rank", F.round("rank", 6)), t.users, TOP_K)


@query
def community_pagerank_bucketed(t: SocialTables) -> DataFrame:
    """PageRank as large graphs run it: salted bucketed edges, ranks bucketed on id."""
    return pageranks(t, broadcast_max_vertices=0).select("community", "id", F.round("rank", 6).alias("rank"))


@query
def pagerank_leaders(t: SocialTables) -> DataFrame:
    """Influencers by unrounded PageRank, shown as multiples of the community's mean rank."""
    best = comm.pagerank_leaders(comm.relative_ranks(pageranks(t)), t.users, TOP_K)
    return best.withColumn("rank", F.round("rank", 6))


@query
def kv_users(t: SocialTables) -> DataFrame:
    path = scratch_path(t.spark, "kv-user")
    files.write_keyed(serving.keyed_users(propagation.labelled_output(labelled(t))), path, "key")
    return files.read_stage(t.spark, path)


@query
def kv_communities(t: SocialTables) -> DataFrame:
    path = scratch_path(t.spark, "kv-communities")
    files.write_keyed(serving.keyed_communities(summary(t)), path, "key")
    return files.read_stage(t.spark, path).select("key", "name", text_list("influencers"), "size")


@query
def community_members(t: SocialTables) -> DataFrame:
    return serving.community_members(summary(t))


# ---------------------------------------------------------------- serving


@query
def retweeters(t: SocialTables) -> DataFrame:
    return serving.retweeters(t.tweet_ids)


@query
def reach_by_community(t: SocialTables) -> DataFrame:
    return serving.reach_by_community(serving.retweet_events(t.tweet_ids), labelled(t))


@query
def reach_ranked(t: SocialTables) -> DataFrame:
    def run() -> DataFrame:
        return serving.reach_ranked(serving.reach_by_community(serving.retweet_events(t.tweet_ids), labelled(t)))

    return distilled(t.spark, run, "reach-ranked")


@query
def stages_reach(t: SocialTables) -> DataFrame:
    """From raw JSON through the stored tables of every stage to ranked reach (posts in English)."""

    def run() -> DataFrame:
        paths = Paths(scratch_path(t.spark, "stages"))
        files.write_tweets(t.tweets, paths["input"])
        t.seeds.write.json(paths["seeds"])
        for stage in ("clean", "make", "lpa", "reach"):
            run_stage(t.spark, stage, paths)
        return files.read_stage(t.spark, paths["reach"])

    return distilled(t.spark, run, "stages-reach")


@query
def user_profile(t: SocialTables) -> DataFrame:
    """Profiles of every quoted author, looked up by screen name."""
    quoted_names = ingest.quoted_users(t.tweets).select("screen_name")
    return serving.user_profile(t.users, quoted_names)


@query
def user_timeline(t: SocialTables) -> DataFrame:
    tl = serving.user_timeline(t.event_posts, TIMELINE_N)
    return tl.withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


# ---------------------------------------------------------------- links


@query
def page_links(t: SocialTables) -> DataFrame:
    return links.page_links(t.pages)


#: Endings of links that the pages hold, besides those of archives.
LINK_KINDS = (*links.ARCHIVE_KINDS, "sch", "que", "the")


@query
def archive_links(t: SocialTables) -> DataFrame:
    """Links of some kinds only, resolved the archive way."""
    return links.page_links(t.pages, LINK_KINDS)


@query
def pending_archives(t: SocialTables) -> DataFrame:
    """Links found in the pages whose file is not among the stored pages' own file names."""
    stored = links.stored_listing(t.pages, "url")
    return links.pending_archives(links.page_links(t.pages), stored)


# ---------------------------------------------------------------- streaming


@query
def live_reach(t: SocialTables) -> DataFrame:
    """Retweet events, stored one folder per day, arrive a few files per micro-batch; the counts are read back."""
    spark = t.spark
    source = scratch_path(spark, "live-reach-events")
    events = t.event_retweets.withColumn("day", F.to_date("created_at"))
    events.write.partitionBy("day").parquet(source)
    output = scratch_path(spark, "live-reach-out")
    q = start_live_reach(
        spark,
        source,
        events.schema,
        labelled(t),
        output,
        max_files_per_trigger=8,
        state_partitions=spark.sparkContext.defaultParallelism,
    )
    q.awaitTermination()
    return read_live_reach(spark, output)


@query
def live_reach_log(t: SocialTables) -> DataFrame:
    """The same events through the log of pairs, merged into snapshots every few micro-batches."""
    spark = t.spark
    source, output, labels = (scratch_path(spark, f"reach-{x}") for x in ("events", "log", "labels"))
    events = t.event_retweets.withColumn("day", F.to_date("created_at"))
    events.write.partitionBy("day").parquet(source)
    labelled(t).select("id", "label").write.parquet(labels)
    start_reach_log(spark, source, events.schema, labels, output, max_files_per_trigger=8).awaitTermination()
    log, lab = ReachLog(spark, output), files.read_stage(spark, labels)
    log.merge(lab)
    return log.reach(lab)
