"""Cleaning raw posts: user profiles and who-references-whom.

Each operator reads the post table once. The three kinds of user (author,
quoted author, retweeted author) and the two kinds of reference (retweet,
quote) come out of one scan as a generated array, not as unions of
separately filtered scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import user_columns
from ..schemas import TWEET_SCHEMA, USER_FIELDS


def _in_lang(tweets: DataFrame, lang: str | None) -> DataFrame:
    return tweets if lang is None else tweets.filter(F.col("lang") == lang)


def tweeters(tweets: DataFrame, lang: str | None = "en") -> DataFrame:
    """Profiles of the authors of posts in ``lang`` (one row per post)."""
    return _in_lang(tweets, lang).select(*user_columns("user"))


def quoted_users(tweets: DataFrame, lang: str | None = "en") -> DataFrame:
    """Profiles of quoted authors, one row per quoting post in ``lang``."""
    return (
        _in_lang(tweets, lang)
        .filter(F.col("quoted_status").isNotNull())
        .select(F.col("quoted_status.user").alias("user"))
        .select(*user_columns("user"))
    )


def retweeted_users(tweets: DataFrame, lang: str | None = "en") -> DataFrame:
    """Profiles of retweeted authors, one row per retweet in ``lang``."""
    return (
        _in_lang(tweets, lang)
        .filter(F.col("retweeted_status").isNotNull())
        .select(F.col("retweeted_status.user").alias("user"))
        .select(*user_columns("user"))
    )


def all_users(tweets: DataFrame, lang: str | None = "en") -> DataFrame:
    """Author, quoted and retweeted profiles of every post, duplicates kept, in one scan."""
    roles = F.array(
        F.struct(F.lit(True).alias("present"), F.col("user").alias("u")),
        F.struct(F.col("quoted_status").isNotNull().alias("present"), F.col("quoted_status.user").alias("u")),
        F.struct(
            F.col("retweeted_status").isNotNull().alias("present"), F.col("retweeted_status.user").alias("u")
        ),
    )
    return (
        _in_lang(tweets, lang)
        .select(F.explode(F.filter(roles, lambda r: r["present"])).alias("r"))
        .select(*user_columns("r.u"))
    )


def dedupe_users(users: DataFrame) -> DataFrame:
    """One row per non-null id: greatest screen name, then greatest counts and description.

    ``row_number() = 1`` is planned with a partial group limit before the
    shuffle, so a user seen in millions of posts ships one row per map task.
    """
    # screen_name first, then the counts, then description: a total order on the row
    order = [
        F.col("screen_name").desc_nulls_last(),
        F.col("followers_count").desc_nulls_last(),
        F.col("statuses_count").desc_nulls_last(),
        F.col("friends_count").desc_nulls_last(),
        F.col("description").desc_nulls_last(),
    ]
    w = Window.partitionBy("id").orderBy(*order)
    return (
        users.filter(F.col("id").isNotNull())
        .withColumn("rn", F.row_number().over(w))
        .filter(F.col("rn") == 1)
        .select(*USER_FIELDS)
    )


def user_ids(tweets: DataFrame, lang: str | None = "en") -> DataFrame:
    """Each non-null id of an author, quoted or retweeted user once (partial aggregate before the shuffle)."""
    return all_users(tweets, lang).select("id").filter(F.col("id").isNotNull()).distinct()


def with_profiles(users: DataFrame, profiles: DataFrame, spread_nulls: bool = True) -> DataFrame:
    """The ids of ``users`` with what ``profiles`` tells of them, whatever role they had, by one join.

    An id without a profile keeps a row of nulls; one with several gets a row
    for each. Null ids match nothing; they are spread over the tasks by the
    partition that they come from. Without ``spread_nulls`` (for ids that are
    known not to be null) the rows stay partitioned by ``id`` for what follows.
    """
    nobody = F.concat(F.lit("\u0000"), F.spark_partition_id().cast("string"))
    asked = users.select("id", F.coalesce("id", nobody).alias("_key")) if spread_nulls else users.select("id")
    known = profiles.filter(F.col("id").isNotNull()).select(
        F.col("id").alias("_known"), *[f for f in USER_FIELDS if f != "id"]
    )
    key = F.col("_key" if spread_nulls else "id")
    return asked.join(known, key == F.col("_known"), "left").select(*USER_FIELDS)


def clean_users(tweets: DataFrame, lang: str | None = "en") -> DataFrame:
    """The users table: every profile seen in ``lang`` posts, one row per id."""
    return dedupe_users(all_users(tweets, lang))


def gather_references(tweets: DataFrame, lang: str | None = "en") -> DataFrame:
    """(src, dst): one row per retweet and one per quote; a retweet of a quote gives two.

    The presence test is on the status struct, so a status whose author id is
    null still yields a row (with a null ``dst``).
    """
    refs = F.array(
        F.struct(
            F.col("retweeted_status").isNotNull().alias("present"),
            F.col("retweeted_status.user.id").alias("dst"),
        ),
        F.struct(
            F.col("quoted_status").isNotNull().alias("present"), F.col("quoted_status.user.id").alias("dst")
        ),
    )
    return (
        _in_lang(tweets, lang)
        .filter(F.col("retweeted_status").isNotNull() | F.col("quoted_status").isNotNull())
        .select(F.col("user.id").alias("src"), F.explode(F.filter(refs, lambda r: r["present"])).alias("r"))
        .select("src", F.col("r.dst").alias("dst"))
    )


def prune_tweets(tweets: DataFrame, lang: str | None = "en") -> DataFrame:
    """Only what cleaning reads: posts in ``lang`` with their three users, status ids, text and counts.

    Stored once as parquet, it lets users, references, retweets and posts be
    derived without parsing the raw JSON twice.
    """
    return _in_lang(tweets, lang).select(*TWEET_SCHEMA.names)


def flatten_tweets(tweets: DataFrame) -> DataFrame:
    """Flat columns of the raw post shape (what the JSON scan is checked on)."""
    return tweets.select(
        "lang",
        "created_at",
        F.col("user.id").alias("author_id"),
        F.col("user.screen_name").alias("author_name"),
        F.col("user.followers_count").alias("author_followers"),
        F.col("retweeted_status.id").alias("rt_post_id"),
        F.col("retweeted_status.user.id").alias("rt_author_id"),
        F.col("quoted_status.user.id").alias("qt_author_id"),
    )
