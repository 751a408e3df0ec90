"""Headline-query benchmark. Prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set), BENCH_WARMUP_DIR
(default /root/testdata/sf0.001; empty to skip).
Each query runs to completion into Spark's no-op sink (nothing is collected).
Before timing, the same queries run once on the small warm-up tables so JVM
start-up and JIT compilation are not counted; the warm-up is not reported.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "edges_weighted",
    "unique_users",
    "lpa_run10",
    "communities",
    "community_pagerank",
    "reach_by_community",
)

#: The same work as large graphs do it; timed after the headline and not part of its total.
LARGE_GRAPH = ("lpa_run10_bucketed", "community_pagerank_bucketed")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]

    from cliqueflow.plans.catalog import QUERIES
    from cliqueflow.session import build_session

    spark = build_session("cliqueflow-bench", cpus=cpus, shuffle_partitions=int(cpus) * 2)
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001").rstrip("/")
    more = LARGE_GRAPH if "BENCH_QUERIES" not in os.environ else ()
    if warm_dir and os.path.isdir(warm_dir):
        for name in (*names, *more):
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in (*names, *more):
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    large = {name: times.pop(name) for name in more}
    spark.stop()

    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "large_graph": large,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
