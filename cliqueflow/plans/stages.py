"""Stage runner: every stage reads and writes parquet, so each can be rerun on its own.

clean        raw post JSON      -> users, references, retweets, posts; rejected (broken lines)
make         references, seeds  -> vertices, edges
lpa          vertices, edges    -> labelled
communities  labelled, users    -> communities
reach        retweets, labelled -> reach
timeline     posts              -> timeline
kv_users     labelled           -> keyed user table
kv_communities communities      -> keyed communities table
database     kv_users + kv_communities
graph        make + lpa + communities
serve        reach + timeline
all          clean + graph + database
ingestion, vertices             other names of clean and kv_users

Every table that a stage writes gets a line in the manifest: stage, output, rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import communities as comm
from ..operators import graph, ingest, propagation, serving
from ..schemas import TWEET_SCHEMA, Paths
from ..session import drop_path, materialize
from ..sources import files

COMPOSITE = {
    "graph": ("make", "lpa", "communities"),
    "database": ("kv_users", "kv_communities"),
    "serve": ("reach", "timeline"),
    "all": ("clean", "graph", "database"),
    "ingestion": ("clean",),
    "vertices": ("kv_users",),
}
STAGES = ("clean", "make", "lpa", "communities", "reach", "timeline", "kv_users", "kv_communities", *COMPOSITE)


@dataclass
class StageOptions:
    lang: str | None = "en"
    iterations: int = 10
    keep_sinks: bool = False
    top_k: int = 10
    timeline_n: int = 5
    communities: list[str] | str | None = None  # names, or the name of a preset; default: the distinct seed labels
    kv_format: str = "parquet"
    kv_mode: str = "errorifexists"
    kv_options: dict[str, str] = field(default_factory=dict)


def _communities(spark: SparkSession, paths: Paths, options: StageOptions):
    if options.communities is not None:
        return options.communities
    return files.read_seeds(spark, paths["seeds"]).select(F.col("label").alias("name"))


def _write_keyed(rows: DataFrame, path: str, table: str, key: str, options: StageOptions) -> None:
    """Files carry the prefixed ``key``; a connector prefixes the table's name itself and gets the plain key column."""
    if options.kv_format in files.FILE_FORMATS:
        files.write_keyed(rows, path, "key", fmt=options.kv_format, mode=options.kv_mode, options=options.kv_options)
    else:
        files.write_keyed(rows.drop("key"), table, key, fmt=options.kv_format, mode=options.kv_mode, options=options.kv_options)


def read_manifest(spark: SparkSession, paths: Paths) -> DataFrame:
    """(stage, output, rows) of every table that was written, in no order."""
    return spark.read.schema("stage string, output string, rows long").json(paths["manifest"])


def run_stage(spark: SparkSession, stage: str, paths: Paths, options: StageOptions | None = None) -> None:
    options = options or StageOptions()
    if stage not in STAGES:
        raise ValueError(f"unknown stage {stage!r}; expected one of {', '.join(STAGES)}")
    if stage in COMPOSITE:
        for s in COMPOSITE[stage]:
            run_stage(spark, s, paths, options)
        return

    written: list[tuple[str, str, int]] = []

    def note(output: str, rows: int) -> None:
        written.append((stage, output, rows))

    def store(df: DataFrame, output: str) -> None:
        seen = Observation(output)
        files.write_stage(df.observe(seen, F.count(F.lit(1)).alias("rows")), paths[output])
        note(output, seen.get["rows"])

    if stage == "clean":
        # the raw JSON is parsed once, into a narrow language-filtered table all outputs read
        seen = Observation("lines")
        raw = files.count_lines(files.read_raw(spark, paths["input"]), seen)
        broken = F.col("_corrupt_record").isNotNull()
        wanted = F.lit(True) if options.lang is None else F.coalesce(F.col("lang") == options.lang, F.lit(False))
        narrow = raw.filter(broken | (F.col("delete").isNull() & wanted)).select(*TWEET_SCHEMA.names, "_corrupt_record")
        lines, lines_path = materialize(narrow, "clean-lines")
        for kind in ("lines", "broken", "deletes", "posts"):
            note(f"input.{kind}", seen.get[kind])
        posts = lines.filter(~broken)
        store(lines.filter(broken).select(F.col("_corrupt_record").alias("line")), "rejected")
        store(ingest.clean_users(posts, None), "users")
        store(ingest.gather_references(posts, None), "references")
        store(serving.retweet_table(posts), "retweets")
        store(serving.post_table(posts), "posts")
        drop_path(spark, lines_path)
    elif stage == "make":
        refs = files.read_stage(spark, paths["references"])
        # stored range-clustered on (src, dst): null ends stay as rows, and each propagation round's
        # partial sums fold a source's edges before the shuffle
        store(graph.build_edges(refs).repartitionByRange("src", "dst"), "edges")
        # vertex ids come from the stored edges: same ids, far fewer rows than the references
        edges = files.read_stage(spark, paths["edges"])
        seeds = files.read_seeds(spark, paths["seeds"])
        store(graph.build_vertices(edges, seeds), "vertices")
    elif stage == "lpa":
        result = propagation.propagate(
            files.read_stage(spark, paths["vertices"]),
            files.read_stage(spark, paths["edges"]),
            _communities(spark, paths, options),
            iterations=options.iterations,
            keep_sinks=options.keep_sinks,
            materialize_edges=False,
        )
        store(propagation.labelled_output(result), "labelled")
    elif stage == "communities":
        summary = comm.summarise_communities(
            files.read_stage(spark, paths["labelled"]),
            files.read_stage(spark, paths["users"]),
            _communities(spark, paths, options),
            k=options.top_k,
        )
        store(summary, "communities")
    elif stage == "reach":
        reach = serving.reach_by_community(files.read_stage(spark, paths["retweets"]), files.read_stage(spark, paths["labelled"]))
        store(serving.reach_ranked(reach), "reach")
    elif stage == "timeline":
        store(serving.user_timeline(files.read_stage(spark, paths["posts"]), options.timeline_n), "timeline")
    elif stage == "kv_users":
        rows = serving.keyed_users(files.read_stage(spark, paths["labelled"]))
        _write_keyed(rows, paths["kv_users"], "user", "id", options)
    elif stage == "kv_communities":
        rows = serving.keyed_communities(files.read_stage(spark, paths["communities"]))
        _write_keyed(rows, paths["kv_communities"], "communities", "name", options)
    if written:
        lines = spark.createDataFrame(written, "stage string, output string, rows long")
        lines.coalesce(1).write.mode("append").json(paths["manifest"])
