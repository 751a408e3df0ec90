"""Registered queries of the subpackage, and the SQL of those that SQL can express on whole tables."""

from __future__ import annotations

from .alignment import op11_alignment
from .exact_dedup import op12_exact_dedup
from .hard_negatives import op13_hard_negatives
from .jaccard_join import op10_jaccard_join
from .kneser_ney import op5_quality_classifier
from .lm_scoring import op8_lm_scoring
from .packing import op7_packing
from .pieces import op3_pieces
from .pii import op2_pii
from .quality_rules import op6_quality_rules
from .substring_dedup import op1_substring_dedup
from .topk import op9_topk
from .toxicity import op4_toxicity

QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_pii": op2_pii,
    "op3_pieces": op3_pieces,
    "op4_toxicity": op4_toxicity,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_quality_rules": op6_quality_rules,
    "op7_packing": op7_packing,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_topk": op9_topk,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_alignment": op11_alignment,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_hard_negatives": op13_hard_negatives,
}

#: Integer inner products of every hundredth vector with all others, best ten.
TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS ints
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.ints AS DOUBLE[]), CAST(c.ints AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

#: Equal texts; the largest id of each stays.
COPIES_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS body FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY body ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(body) AS text_sha256
FROM t WINDOW same AS (PARTITION BY body)
"""

#: All products of every hundredth vector, its positives, and the negatives near each of them.
NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS ints
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(list_inner_product(CAST(a.ints AS DOUBLE[]), CAST(c.ints AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id
), positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
"""

#: Words of every document, windows of 13 of them, and the words that windows of smaller documents cover.
PASSAGES_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x09-\x0D\x20]+'), lambda x: x <> '') AS w
  FROM documents
), windows AS (
  SELECT r, doc_id, p, array_to_string(w[p : p + 12], ' ') AS g FROM (SELECT r, doc_id, w, unnest(generate_series(1, len(w) - 12)) AS p FROM docs)
), earliest AS (SELECT g, min(doc_id) AS low FROM windows GROUP BY g),
gone AS (
  SELECT DISTINCT r, unnest(generate_series(p, p + 12)) AS p FROM windows JOIN earliest USING (g) WHERE low < doc_id
), words AS (SELECT r, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM docs),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS body FROM words ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""

#: Sets of three-word shingles, pairs that share nine tenths, and the least document that each reaches.
LINKS_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[\x09-\x0D\x20]+'), lambda x: x <> '') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT r, array_to_string(w[p : p + 2], ' ') AS g
  FROM (SELECT r, w, unnest(generate_series(1, greatest(len(w) - 2, least(len(w), 1)))) AS p FROM docs)
), sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
common AS (SELECT a.r AS a, b.r AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.g = b.g AND a.r <> b.r GROUP BY a.r, b.r),
links AS (
  SELECT c.a, c.b FROM common c JOIN sizes x ON x.r = c.a JOIN sizes y ON y.r = c.b WHERE 100 * c.n >= 90 * (x.n + y.n - c.n)
), reach AS (SELECT r AS a, r AS b FROM docs UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
least_of AS (SELECT reach.a AS r, min(docs.doc_id) AS component_id FROM reach JOIN docs ON docs.r = reach.b GROUP BY reach.a)
SELECT docs.doc_id, coalesce(sizes.n, 0) AS n_shingles, least_of.component_id
FROM docs JOIN least_of USING (r) LEFT JOIN sizes USING (r)
"""

ORACLE = {"op1_substring_dedup": PASSAGES_SQL, "op10_jaccard_join": LINKS_SQL, "op9_topk": TOPK_SQL, "op12_exact_dedup": COPIES_SQL, "op13_hard_negatives": NEGATIVES_SQL}
