"""The questions a campaign asks, as batch queries over the stage tables.

Each one answers for every post / community / user at once; an optional
argument narrows it to one, which Catalyst pushes down as a filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import key_of, post_time
from .ranking import rank_within


def retweet_events(tweets: DataFrame, post_id: str | None = None) -> DataFrame:
    """(post_id, id): one row per retweet (repeats kept)."""
    rt = tweets.filter(F.col("retweeted_status").isNotNull())
    if post_id is not None:
        rt = rt.filter(F.col("retweeted_status.id") == post_id)
    return rt.select(F.col("retweeted_status.id").alias("post_id"), F.col("user.id").alias("id")).filter(
        F.col("post_id").isNotNull() & F.col("id").isNotNull()
    )


def retweet_table(tweets: DataFrame) -> DataFrame:
    """(post_id, id, created_at): one row per retweet, as reach and live reach read them."""
    rt = tweets.filter(F.col("retweeted_status").isNotNull())
    return rt.select(F.col("retweeted_status.id").alias("post_id"), F.col("user.id").alias("id"), post_time("created_at").alias("created_at")).filter(
        F.col("post_id").isNotNull() & F.col("id").isNotNull()
    )


def post_table(tweets: DataFrame) -> DataFrame:
    """(author_id, id, created_at, text, retweet_count, favorite_count, rt_post_id): posts as a timeline shows them."""
    return tweets.filter(F.col("user.id").isNotNull()).select(
        F.col("user.id").alias("author_id"),
        "id",
        post_time("created_at").alias("created_at"),
        "text",
        "retweet_count",
        "favorite_count",
        F.col("retweeted_status.id").alias("rt_post_id"),
    )


def retweeters(tweets: DataFrame, post_id: str | None = None) -> DataFrame:
    """(post_id, id): distinct accounts that retweeted each post."""
    return retweet_events(tweets, post_id).distinct()


def reach_by_community(retweets: DataFrame, labelled: DataFrame, post_id: str | None = None) -> DataFrame:
    """(post_id, label, size): distinct labelled retweeters per post and label; unlabelled ones are skipped.

    ``retweets`` may repeat a (post, retweeter) pair: the count is distinct,
    so raw retweet events go straight into the join without a separate
    de-duplicating shuffle.
    """
    rt = retweets.select("post_id", "id")
    if post_id is not None:
        rt = rt.filter(F.col("post_id") == post_id)
    return (
        rt.join(labelled.select("id", "label"), "id")
        .groupBy("post_id", "label")
        .agg(F.count_distinct("id").alias("size"))
    )


def reach_ranked(reach: DataFrame, k: int | None = None) -> DataFrame:
    """(post_id, rank, label, size): communities of each post, largest reach first, ties by label.

    With ``k`` only the first ``k`` per post are kept, limited per map task
    before the shuffle. Without it every label is ranked exactly by
    ``rank_within``, so a post reaching millions of labels is spread over
    many tasks rather than sorted in one.
    """
    order = [F.col("size").desc(), F.col("label").asc_nulls_last()]
    if k is not None:
        w = Window.partitionBy("post_id").orderBy(*order)
        ranked = reach.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= k)
    else:
        ranked = rank_within(reach.filter(F.col("post_id").isNotNull()), ["post_id"], order)
    return ranked.select("post_id", "rank", "label", "size")


def community_members(communities: DataFrame, name: str | None = None) -> DataFrame:
    """(name, position, screen_name): the stored influencer list of each community, one row per name."""
    c = communities if name is None else communities.filter(F.col("name") == name)
    return c.select("name", F.posexplode("influencers").alias("position", "screen_name"))


def user_profile(users: DataFrame, screen_names: DataFrame | list[str]) -> DataFrame:
    """Profiles of the given screen names (a list or a one-column DataFrame)."""
    if isinstance(screen_names, DataFrame):
        names = screen_names.select(F.col(screen_names.columns[0]).alias("screen_name")).distinct()
        return users.join(names, "screen_name", "left_semi").select(*users.columns)
    return users.filter(F.col("screen_name").isin(list(screen_names)))


#: What a timeline shows of a post besides its id and time.
SHOWN = ("text", "retweet_count", "favorite_count")


def user_timeline(posts: DataFrame, n: int = 5, author_id: str | None = None) -> DataFrame:
    """(author_id, position, id, created_at, rt_post_id): latest ``n`` posts per author, newest first.

    Text, retweet_count and favorite_count follow where ``posts`` has them.

    Ties on time are broken by the larger post id (ids are decimal text: the longer one, then by digits). The ``n`` limit is applied
    per map task before the shuffle, so a prolific author ships ``n`` rows per task.
    """
    p = posts if author_id is None else posts.filter(F.col("author_id") == author_id)
    w = Window.partitionBy("author_id").orderBy(F.col("created_at").desc_nulls_last(), F.length("id").desc(), F.col("id").desc())
    return (
        p.withColumn("position", F.row_number().over(w))
        .filter(F.col("position") <= n)
        .select("author_id", "position", "id", "created_at", "rt_post_id", *[c for c in SHOWN if c in posts.columns])
    )


def keyed_users(labelled: DataFrame) -> DataFrame:
    """Rows of the keyed ``user`` table: (key, id, label) with key ``user:<id>``."""
    return labelled.select(key_of("user", "id").alias("key"), "id", "label")


def keyed_communities(communities: DataFrame) -> DataFrame:
    """Rows of the keyed ``communities`` table: (key, name, influencers, size)."""
    return communities.select(key_of("communities", "name").alias("key"), "name", "influencers", "size")
