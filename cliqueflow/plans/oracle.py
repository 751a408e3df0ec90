"""DuckDB oracle SQL for every registered query.

The social views (posts, users, seeds, ...) are stated once as CTEs and
pulled in by name, with their dependencies, in front of each query body.
Propagation and PageRank rounds are chained CTEs, one per round, each
materialised so a round is computed once.
"""

from __future__ import annotations

import re

# name -> CTE body. Dependencies are found by name inside the body.
VIEWS: dict[str, str] = {}


def view(name: str, body: str, materialized: bool = False) -> None:
    VIEWS[name] = (" AS MATERIALIZED (" if materialized else " AS (") + body.strip() + ")"


view("n_customers", "SELECT count(*) AS n FROM customer")
view(
    "posts",
    """
    SELECT CAST(o.o_custkey AS VARCHAR) AS author_id,
           CASE WHEN l.l_linestatus = 'O' THEN 'en' ELSE 'fr' END AS lang,
           o.o_orderdate AS created_at,
           CASE WHEN l.l_returnflag = 'R'
                THEN CAST(l.l_partkey % (SELECT n FROM n_customers) AS VARCHAR) END AS rt_author_id,
           CASE WHEN l.l_returnflag = 'A' THEN CAST(l.l_suppkey AS VARCHAR) END AS qt_author_id,
           CAST(l.l_partkey AS VARCHAR) AS rt_post_id
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    """,
)
view(
    "users",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS screen_name,
           CAST(c_nationkey AS BIGINT) AS statuses_count,
           CAST(floor(c_acctbal) AS BIGINT) AS followers_count,
           CAST(c_custkey % 7 AS BIGINT) AS friends_count,
           c_mktsegment AS description
    FROM customer
    """,
)
view(
    "refs",
    """
    SELECT author_id AS src, rt_author_id AS dst FROM posts WHERE rt_author_id IS NOT NULL AND lang = 'en'
    UNION ALL
    SELECT author_id AS src, qt_author_id AS dst FROM posts WHERE qt_author_id IS NOT NULL AND lang = 'en'
    """,
)
view("edges", "SELECT src, dst, count(*) AS weight FROM refs GROUP BY src, dst", materialized=True)
view(
    "seeds",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS id, r.r_name AS label, true AS prelabelled
    FROM (SELECT c_custkey, c_nationkey,
                 row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey ASC) AS rn
          FROM customer) c
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
    WHERE c.rn = 1
    """,
)
view("comms", "SELECT DISTINCT label AS name FROM seeds")
view("vids", "SELECT src AS id FROM refs WHERE src IS NOT NULL UNION SELECT dst FROM refs WHERE dst IS NOT NULL")
view(
    "v0",
    """
    SELECT id, id AS label, false AS prelabelled FROM vids WHERE id NOT IN (SELECT id FROM seeds)
    UNION ALL SELECT id, label, prelabelled FROM seeds
    """,
    materialized=True,
)


def _lpa_round(prev: str, keep_sinks: bool) -> str:
    join = "LEFT JOIN" if keep_sinks else "JOIN"
    return f"""
    SELECT id, label, COALESCE(label IN (SELECT name FROM comms), false) AS prelabelled
    FROM (
      SELECT v.id, CASE WHEN v.prelabelled THEN v.label ELSE COALESCE(b.label, v.label) END AS label
      FROM {prev} v {join} (
        SELECT id, label FROM (
          SELECT s.id, s.label,
                 row_number() OVER (PARTITION BY s.id ORDER BY s.score DESC, s.label ASC NULLS FIRST) AS rn
          FROM (SELECT e.src AS id, d.label,
                       SUM(CASE WHEN d.prelabelled THEN 2 * e.weight ELSE e.weight END) AS score
                FROM edges e JOIN {prev} d ON e.dst = d.id
                WHERE e.src IS NOT NULL
                GROUP BY e.src, d.label) s) t
        WHERE rn = 1) b ON v.id = b.id) x
    """


def lpa_chain(rounds: int, keep_sinks: bool = False) -> str:
    """Define views lpa{k|s}{1..rounds}; returns the last name."""
    tag = "s" if keep_sinks else "d"
    prev = "v0"
    for i in range(1, rounds + 1):
        name = f"lpa{tag}{i}"
        if name not in VIEWS:
            view(name, _lpa_round(prev, keep_sinks), materialized=True)
        prev = name
    return prev


def with_views(body: str) -> str:
    """Prefix ``body`` with the WITH clause of every view it needs, dependencies first."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in order and re.search(rf"\b{re.escape(name)}\b", text):
                visit(VIEWS[name])
                if name not in order:
                    order.append(name)

    visit(body)
    if not order:
        return body.strip()
    return "WITH " + ",\n".join(f"{n}{VIEWS[n]}" for n in order) + "\n" + body.strip()


view(
    "event_posts",
    """
    SELECT CAST(event_id AS VARCHAR) AS id, ts AS created_at, CAST(user_id AS VARCHAR) AS author_id,
           CASE WHEN event_type = 'view' THEN regexp_extract(props, '([0-9]+)', 1) END AS rt_post_id
    FROM events
    """,
)
view(
    "hrefs",
    """
    SELECT page_id, url, unnest(regexp_extract_all(html, '<a[^>]*href="([^"]*)"', 1)) AS href FROM pages
    """,
)
view(
    "links",
    """
    SELECT DISTINCT CASE
        WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href
        WHEN starts_with(href, '/') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1) || href
        ELSE regexp_extract(regexp_replace(url, '[?#].*$', ''), '^(.*/)', 1) || href END AS link
    FROM hrefs
    """,
)

USER_COLS = "screen_name, statuses_count, followers_count, friends_count, description"


def _profiles(id_col: str, where: str) -> str:
    cols = ", ".join(f"u.{c}" for c in USER_COLS.split(", "))
    return f"SELECT p.{id_col} AS id, {cols} FROM posts p LEFT JOIN users u ON p.{id_col} = u.id WHERE {where}"


view("tweeters", _profiles("author_id", "p.lang = 'en'"))
view("quoted", _profiles("qt_author_id", "p.lang = 'en' AND p.qt_author_id IS NOT NULL"))
view("retweeted", _profiles("rt_author_id", "p.lang = 'en' AND p.rt_author_id IS NOT NULL"))
view(
    "retweets",
    """
    SELECT DISTINCT rt_post_id AS post_id, author_id AS id FROM posts
    WHERE rt_author_id IS NOT NULL AND rt_post_id IS NOT NULL AND author_id IS NOT NULL
    """,
)

LPA_D10 = lpa_chain(10)
LPA_S10 = lpa_chain(10, keep_sinks=True)

view(
    "members",
    f"""
    SELECT l.id, l.label, u.screen_name, u.followers_count
    FROM {LPA_D10} l JOIN users u ON l.id = u.id
    WHERE l.label IN (SELECT name FROM comms)
    """,
)
view(
    "top10",
    """
    SELECT * FROM (
      SELECT label AS name,
             CAST(row_number() OVER (PARTITION BY label ORDER BY followers_count DESC NULLS LAST,
                                     screen_name ASC NULLS LAST, id ASC) AS INTEGER) AS position,
             id, screen_name, followers_count
      FROM members) t
    WHERE position <= 10
    """,
)
view(
    "summary",
    """
    SELECT s.name, COALESCE(i.influencers, '') AS influencers, s.size
    FROM (SELECT label AS name, CAST(count(*) AS INTEGER) AS size FROM members GROUP BY label) s
    LEFT JOIN (SELECT name, string_agg(screen_name, ',' ORDER BY position) AS influencers
               FROM top10 WHERE screen_name IS NOT NULL GROUP BY name) i ON s.name = i.name
    """,
)
view(
    "reach",
    f"""
    SELECT r.post_id, l.label, count(DISTINCT r.id) AS size
    FROM retweets r JOIN {LPA_D10} l ON r.id = l.id
    GROUP BY r.post_id, l.label
    """,
)


def pagerank_chain(rounds: int, damping: float = 0.85) -> str:
    view("pr_members", f"SELECT id, label AS community FROM {LPA_D10} WHERE label IN (SELECT name FROM comms)")
    view("pr_sizes", "SELECT community, CAST(count(*) AS DOUBLE) AS n FROM pr_members GROUP BY community")
    view(
        "pr_inner",
        """
        SELECT e.src, e.dst, CAST(e.weight AS DOUBLE) AS weight
        FROM edges e JOIN pr_members s ON e.src = s.id JOIN pr_members d ON e.dst = d.id
        WHERE s.community = d.community
        """,
    )
    view(
        "pr_shares",
        """
        SELECT i.src, i.dst, i.weight / o.w AS share
        FROM pr_inner i JOIN (SELECT src, sum(weight) AS w FROM pr_inner GROUP BY src) o ON i.src = o.src
        """,
        materialized=True,
    )
    view(
        "pr_nodes",
        """
        SELECT m.id, m.community, z.n, m.id IN (SELECT src FROM pr_shares) AS has_out
        FROM pr_members m JOIN pr_sizes z ON m.community = z.community
        """,
        materialized=True,
    )
    view("pr0", "SELECT id, community, 1.0 / n AS rank FROM pr_nodes", materialized=True)
    teleport, d = repr(1.0 - damping), repr(damping)
    for i in range(1, rounds + 1):
        view(
            f"pr{i}",
            f"""
            SELECT x.id, x.community,
                   {teleport} / x.n + {d} * (COALESCE(f.inflow, 0.0) + COALESCE(s.sink_mass, 0.0) / x.n) AS rank
            FROM pr_nodes x
            LEFT JOIN (SELECT sh.dst AS id, sum(r.rank * sh.share) AS inflow
                       FROM pr_shares sh JOIN pr{i - 1} r ON sh.src = r.id GROUP BY sh.dst) f ON x.id = f.id
            LEFT JOIN (SELECT r.community, sum(r.rank) AS sink_mass
                       FROM pr{i - 1} r JOIN pr_nodes y ON r.id = y.id
                       WHERE NOT y.has_out GROUP BY r.community) s ON x.community = s.community
            """,
            materialized=True,
        )
    return f"pr{rounds}"


PR5 = pagerank_chain(5)

ORACLE: dict[str, str] = {}


def oracle(name: str, body: str) -> None:
    ORACLE[name] = with_views(body)


oracle(
    "tweets_scan",
    """
    SELECT p.lang, strftime(p.created_at, '%Y-%m-%d %H:%M:%S') AS created_at,
           p.author_id, u.screen_name AS author_name, u.followers_count AS author_followers,
           CASE WHEN p.rt_author_id IS NOT NULL THEN p.rt_post_id END AS rt_post_id,
           p.rt_author_id, p.qt_author_id
    FROM posts p LEFT JOIN users u ON p.author_id = u.id
    """,
)
oracle("tweeters", "SELECT * FROM tweeters")
oracle("quoted_users", "SELECT * FROM quoted")
oracle("retweeted_users", "SELECT * FROM retweeted")
oracle("all_users", "SELECT * FROM tweeters UNION ALL SELECT * FROM quoted UNION ALL SELECT * FROM retweeted")
UNIQUE_USERS = f"""
SELECT id, {USER_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY screen_name DESC NULLS LAST,
         followers_count DESC NULLS LAST, statuses_count DESC NULLS LAST,
         friends_count DESC NULLS LAST, description DESC NULLS LAST) AS rn
  FROM (SELECT * FROM tweeters UNION ALL SELECT * FROM quoted UNION ALL SELECT * FROM retweeted) a
  WHERE id IS NOT NULL) t
WHERE rn = 1
"""
oracle("unique_users", UNIQUE_USERS)
oracle("stages_users", UNIQUE_USERS)
oracle("references", "SELECT src, dst FROM refs")
oracle("edges_weighted", "SELECT src, dst, weight FROM edges")
oracle("vertices_distinct", "SELECT id FROM vids")
oracle("vertices_initial", "SELECT id, id AS label, false AS prelabelled FROM vids")
oracle("vertices_seeded", "SELECT id, label, prelabelled FROM v0")
ASSOC = """
    SELECT e.src, e.dst, CASE WHEN d.prelabelled THEN 2 * e.weight ELSE e.weight END AS weight, d.label
    FROM edges e JOIN v0 d ON e.dst = d.id WHERE e.src IS NOT NULL
"""
oracle("lpa_associations", ASSOC)
oracle(
    "lpa_outgoing",
    f"""
    SELECT v.id, v.label, v.prelabelled, a.label AS out_label, a.weight AS out_weight
    FROM ({ASSOC}) a JOIN v0 v ON a.src = v.id
    """,
)
oracle("lpa_scores", f"SELECT src AS id, label, CAST(sum(weight) AS BIGINT) AS score FROM ({ASSOC}) a GROUP BY src, label")
oracle("lpa_step", f"SELECT id, label, prelabelled FROM {lpa_chain(1)}")
oracle("lpa_step_keep_sinks", f"SELECT id, label, prelabelled FROM {lpa_chain(1, keep_sinks=True)}")
oracle("lpa_run3", f"SELECT id, label, prelabelled FROM {lpa_chain(3)}")
oracle("lpa_run10", f"SELECT id, label, prelabelled FROM {LPA_D10}")
oracle("lpa_run10_keep_sinks", f"SELECT id, label, prelabelled FROM {LPA_S10}")
oracle("lpa_run10_bucketed", f"SELECT id, label, prelabelled FROM {LPA_D10}")
oracle("lpa_run10_keep_sinks_bucketed", f"SELECT id, label, prelabelled FROM {LPA_S10}")
oracle("labelled_output", f"SELECT id, label FROM {LPA_D10}")
oracle("community_members_join", "SELECT id, label, screen_name, followers_count FROM members")
oracle("community_size", "SELECT label AS name, CAST(count(*) AS INTEGER) AS size FROM members GROUP BY label")
oracle("community_top10", "SELECT name, position, id, screen_name, followers_count FROM top10")
oracle("communities", "SELECT name, influencers, size FROM summary")
oracle("community_pagerank", f"SELECT community, id, round(rank, 6) AS rank FROM {PR5}")
oracle("community_pagerank_bucketed", f"SELECT community, id, round(rank, 6) AS rank FROM {PR5}")
oracle(
    "pagerank_leaders",
    f"""
    SELECT t.community AS name, t.position, t.id, u.screen_name, round(t.rank, 6) AS rank
    FROM (SELECT community, id, rank,
                 CAST(row_number() OVER (PARTITION BY community ORDER BY rank DESC, id ASC) AS INTEGER) AS position
          FROM (SELECT r.community, r.id, round(r.rank * z.n, 9) AS rank
                FROM {PR5} r JOIN pr_sizes z ON r.community = z.community) r) t
    LEFT JOIN users u ON t.id = u.id
    WHERE t.position <= 10
    """,
)
oracle(
    "pagerank_top10",
    f"""
    SELECT t.community AS name, t.position, t.id, u.screen_name, t.rank
    FROM (SELECT community, id, rank,
                 CAST(row_number() OVER (PARTITION BY community ORDER BY rank DESC, id ASC) AS INTEGER) AS position
          FROM (SELECT community, id, round(rank, 6) AS rank FROM {PR5}) r) t
    LEFT JOIN users u ON t.id = u.id
    WHERE t.position <= 10
    """,
)
oracle("kv_users", f"SELECT 'user:' || id AS key, id, label FROM {LPA_D10}")
oracle("kv_communities", "SELECT 'communities:' || name AS key, name, influencers, size FROM summary")
oracle(
    "community_members",
    """
    SELECT name, CAST(row_number() OVER (PARTITION BY name ORDER BY position) - 1 AS INTEGER) AS position,
           screen_name
    FROM top10 WHERE screen_name IS NOT NULL
    """,
)
oracle("retweeters", "SELECT post_id, id FROM retweets")
oracle("reach_by_community", "SELECT post_id, label, size FROM reach")
oracle(
    "reach_ranked",
    """
    SELECT post_id,
           row_number() OVER (PARTITION BY post_id ORDER BY size DESC, label ASC NULLS LAST) AS rank,
           label, size
    FROM reach
    """,
)
oracle(
    "stages_reach",
    f"""
    SELECT post_id, row_number() OVER (PARTITION BY post_id ORDER BY size DESC, label ASC NULLS LAST) AS rank, label, size
    FROM (SELECT r.rt_post_id AS post_id, l.label, count(DISTINCT l.id) AS size
          FROM posts r JOIN {LPA_D10} l ON r.author_id = l.id
          WHERE r.rt_author_id IS NOT NULL AND r.rt_post_id IS NOT NULL AND r.lang = 'en'
          GROUP BY r.rt_post_id, l.label) x
    """,
)
oracle(
    "user_profile",
    """
    SELECT * FROM users
    WHERE screen_name IN (SELECT screen_name FROM quoted WHERE screen_name IS NOT NULL)
    """,
)
oracle(
    "user_timeline",
    """
    SELECT author_id, position, id, strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS created_at, rt_post_id
    FROM (SELECT *, CAST(row_number() OVER (PARTITION BY author_id ORDER BY created_at DESC NULLS LAST, length(id) DESC, id DESC)
                         AS INTEGER) AS position
          FROM event_posts) t
    WHERE position <= 5
    """,
)
oracle("page_links", "SELECT link FROM links")
oracle(
    "archive_links",
    """
    SELECT DISTINCT CASE WHEN right(href, 3) <> 'zst' THEN url || href
                         WHEN instr(href, '.') = 0 THEN href
                         ELSE substr(href, 1, instr(href, '.') - 1) || url || substr(href, instr(href, '.') + 1) END AS link
    FROM hrefs WHERE right(href, 3) IN ('zst', 'tar', 'sch', 'que', 'the')
    """,
)
oracle(
    "pending_archives",
    """
    SELECT link, file_name FROM (
      SELECT link, substr(f, 1, greatest(length(f) - 4, 0)) AS file_name
      FROM (SELECT link, split_part(link, '/', -1) AS f FROM links) a) l
    WHERE file_name NOT IN (SELECT DISTINCT split_part(url, '/', -1) FROM pages WHERE url IS NOT NULL)
    """,
)
LIVE = f"""
    SELECT r.post_id, l.label, count(DISTINCT r.id) AS size
    FROM (SELECT rt_post_id AS post_id, author_id AS id FROM event_posts WHERE rt_post_id IS NOT NULL) r
    JOIN {LPA_D10} l ON r.id = l.id
    GROUP BY r.post_id, l.label
    """
oracle("live_reach", LIVE)
oracle("live_reach_log", LIVE)
