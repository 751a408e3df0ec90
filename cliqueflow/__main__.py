"""Command line: ``python -m cliqueflow <stage> --root <uri> [options]``.

Runs one stage (or a composite: graph, database, all) of ``plans.stages`` on
the session Spark configures (spark-defaults, ``PYSPARK_SUBMIT_ARGS``); the
session must name a shared ``spark.checkpoint.dir`` when it is not local.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .plans.stages import STAGES, StageOptions, run_stage
from .schemas import Paths


def parse(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="cliqueflow", description="Run a stage of the community pipeline.")
    p.add_argument("stage", choices=STAGES)
    p.add_argument("--root", required=True, help="folder (any Hadoop URI) holding raw/, prelabelled/, ...")
    p.add_argument("--iterations", type=int, default=10)
    p.add_argument("--keep-sinks", action="store_true")
    p.add_argument("--lang", default="en", help="post language to keep; empty for all")
    p.add_argument("--top-k", type=int, default=10)
    p.add_argument("--communities", default=None, help="comma-separated names, or preset:NAME (default: the seed labels)")
    p.add_argument("--kv-format", default="parquet")
    p.add_argument("--kv-mode", default="errorifexists")
    return p.parse_args(argv)


def listed(names: str | None) -> list[str] | str | None:
    if names and names.startswith("preset:"):
        return names.removeprefix("preset:")
    return [c for c in names.split(",") if c] if names else None


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parse(sys.argv[1:] if argv is None else argv)
    spark = spark or SparkSession.builder.appName(f"cliqueflow-{args.stage}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    options = StageOptions(
        lang=args.lang or None,
        iterations=args.iterations,
        keep_sinks=args.keep_sinks,
        top_k=args.top_k,
        communities=listed(args.communities),
        kv_format=args.kv_format,
        kv_mode=args.kv_mode,
    )
    run_stage(spark, args.stage, Paths(args.root), options)


if __name__ == "__main__":
    main()
