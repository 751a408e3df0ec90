"""File sources and sinks: raw post JSON, seed JSON, stage parquet, keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import RAW_SCHEMA, SEED_SCHEMA, TWEET_SCHEMA

#: Formats whose keyed tables are folders.
FILE_FORMATS = ("parquet", "orc", "json")


def read_tweets(spark: SparkSession, path: str, schema: StructType = TWEET_SCHEMA) -> DataFrame:
    """Scan a folder (or glob) of JSON-lines posts with a fixed schema.

    Lines that do not parse, and archive "delete" records, come out with a
    null ``lang`` and are dropped by the language filter of every consumer.
    """
    return (
        spark.read.schema(schema)
        .option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE")
        .option("multiLine", "false")
        .json(path)
    )


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """``read_tweets`` that also tells what a line without a post is: ``_corrupt_record`` (a broken line) or ``delete``."""
    return read_tweets(spark, path, RAW_SCHEMA)


def count_lines(raw: DataFrame, seen: Observation) -> DataFrame:
    """``raw`` of ``read_raw``; the job that reads it observes how many lines, posts, deletes and broken lines there are."""
    broken, deleted = F.col("_corrupt_record").isNotNull(), F.col("delete").isNotNull()
    kinds = {"broken": broken, "deletes": ~broken & deleted, "posts": ~broken & ~deleted}
    return raw.observe(seen, F.count(F.lit(1)).alias("lines"), *[F.count(F.when(c, 1)).alias(k) for k, c in kinds.items()])


#: Lines of one file of posts (some 20 MB packed): a reader takes a packed file whole.
FILE_LINES = 500_000


def write_tweets(tweets: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, packed by gzip, in files of bounded length: a reader deals out the files."""
    tweets.write.mode(mode).option("compression", "gzip").option("maxRecordsPerFile", FILE_LINES).json(path)


def list_objects(spark: SparkSession, path: str) -> DataFrame:
    """(path): every file below ``path``, by the listing alone; no content is read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """Seed labels, one JSON object per line: ``{"id", "label", "prelabelled"}``."""
    return spark.read.schema(SEED_SCHEMA).json(path)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_stage(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def check_key(df: DataFrame, key: str) -> None:
    """Fail when ``key`` is null or repeated: a keyed store would silently keep one row."""
    bad = (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col(key).isNull() | (F.col("n") > 1))
        .limit(1)
        .collect()
    )
    if bad:
        raise ValueError(f"key column {key!r} is null or not unique, e.g. {bad[0][key]!r}")


def write_keyed(
    df: DataFrame,
    table: str,
    key: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    options: dict[str, str] | None = None,
) -> None:
    """Save a table addressed by ``key``.

    For ``parquet``/``orc``/``json`` the ``table`` is a path. Any other format
    is a connector that receives ``table`` and ``key.column`` as options and
    makes its keys of both; one of Spark's newer interface takes no mode but
    ``append`` and ``overwrite``.
    """
    check_key(df, key)
    writer = df.write.mode(mode)
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    if fmt in FILE_FORMATS:
        writer.format(fmt).save(table)
    else:
        writer.format(fmt).option("table", table).option("key.column", key).save()
