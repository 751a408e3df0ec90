"""Fixed schemas of every stage table, plus the stage folder layout."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

USER_FIELDS = (
    "id",
    "screen_name",
    "statuses_count",
    "followers_count",
    "friends_count",
    "description",
)

USER_TYPE = StructType(
    [
        StructField("id", StringType()),
        StructField("screen_name", StringType()),
        StructField("statuses_count", LongType()),
        StructField("followers_count", LongType()),
        StructField("friends_count", LongType()),
        StructField("description", StringType()),
    ]
)

STATUS_TYPE = StructType([StructField("id", StringType()), StructField("user", USER_TYPE)])

# Raw post JSON. Passed explicitly: no inference pass, and only these fields are parsed.
TWEET_SCHEMA = StructType(
    [
        StructField("id", StringType()),
        StructField("lang", StringType()),
        StructField("created_at", StringType()),
        StructField("text", StringType()),
        StructField("retweet_count", LongType()),
        StructField("favorite_count", LongType()),
        StructField("user", USER_TYPE),
        StructField("retweeted_status", STATUS_TYPE),
        StructField("quoted_status", STATUS_TYPE),
    ]
)

# The same with what tells deleted posts and broken lines apart.
RAW_SCHEMA = StructType(
    [
        *TWEET_SCHEMA.fields,
        StructField("delete", StructType([StructField("status", StructType([StructField("id", StringType())]))])),
        StructField("_corrupt_record", StringType()),
    ]
)

SEED_SCHEMA = StructType(
    [
        StructField("id", StringType()),
        StructField("label", StringType()),
        StructField("prelabelled", BooleanType()),
    ]
)

USERS_SCHEMA = USER_TYPE
REFERENCES_SCHEMA = StructType([StructField("src", StringType()), StructField("dst", StringType())])
VERTEX_SCHEMA = SEED_SCHEMA
EDGE_SCHEMA = StructType(
    [
        StructField("src", StringType()),
        StructField("dst", StringType()),
        StructField("weight", LongType(), False),
    ]
)
LABELLED_SCHEMA = StructType([StructField("id", StringType()), StructField("label", StringType())])
COMMUNITY_SCHEMA = StructType(
    [
        StructField("name", StringType(), False),
        StructField("influencers", ArrayType(StringType(), False), False),
        StructField("size", IntegerType(), False),
    ]
)

# The community names the original job hard-codes (the default list is the seed labels).
REFERENCE_COMMUNITIES = (
    "Bernie", "Biden", "Buttigieg", "Warren", "Trump", "Clinton", "Leftist Media", "CNN", "MSNBC",
    "FOX", "Libertarian", "IDW", "AltRight", "BJP", "Tech", "Sports", "Joe Rogan",
)
#: Lists of communities that can be asked for by name.
PRESETS = {"politics": REFERENCE_COMMUNITIES}


@dataclass(frozen=True)
class Paths:
    """Folder of every stage table below one root (any Hadoop URI)."""

    root: str
    input: str = "raw"
    references: str = "references"
    users: str = "users"
    retweets: str = "retweets"
    posts: str = "posts"
    rejected: str = "rejected"
    manifest: str = "manifest"
    reach: str = "reach"
    timeline: str = "timeline"
    seeds: str = "prelabelled"
    vertices: str = "vertices"
    edges: str = "edges"
    labelled: str = "labelled"
    communities: str = "communities"
    kv_users: str = "kv/user"
    kv_communities: str = "kv/communities"

    def __getitem__(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{getattr(self, name)}"
