"""Print the formatted physical plan of each core operator over a scale-factor folder.

Usage: python tools/explain_plans.py [sf_dir] [name ...]
Plans are built lazily (no propagation loop runs); the vertex table of the
first round stands in where an operator needs labels.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv):
    from cliqueflow.operators import communities as comm
    from cliqueflow.operators import graph, ingest, links, propagation, serving
    from cliqueflow.plans import catalog
    from cliqueflow.session import build_session
    from cliqueflow.sources.social import SocialTables

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = set(argv[2:])
    spark = build_session("explain", cpus=8, shuffle_partitions=16)
    t = SocialTables(spark, sf_dir)
    refs = catalog.refs_of(t)
    v, e = graph.build_vertices(refs, t.seeds, validate=False), graph.build_edges(refs)
    names = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
    lab = v.select("id", "label")
    plans = {
        "edges_weighted": lambda: e,
        "unique_users": lambda: ingest.dedupe_users(ingest.with_profiles(ingest.user_ids(t.tweet_ids), t.users, spread_nulls=False)),
        "lpa_step": lambda: propagation.lpa_step(v, e, names),
        "lpa_step_broadcast": lambda: propagation.lpa_step(v, e, names, broadcast_vertices=True),
        "community_top10": lambda: comm.community_top_k(comm.community_members_join(lab, t.users, names)),
        "reach_by_community": lambda: serving.reach_by_community(serving.retweet_events(t.tweets), lab),
        "user_timeline": lambda: serving.user_timeline(t.event_posts),
        "page_links": lambda: links.page_links(t.pages),
    }
    for name, build in plans.items():
        if wanted and name not in wanted:
            continue
        print(f"\n===== {name}")
        build().explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
