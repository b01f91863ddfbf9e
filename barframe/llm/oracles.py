"""SQL for the operators that SQL can express, on the same tables."""

from __future__ import annotations

from barframe.llm.fillmiddle import FILL_SQL
from barframe.llm.meansearch import CLUSTER_SQL
from barframe.llm.mixing import MIX_SQL

COMPONENTS = """
sides AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a AS node, b AS other FROM sides UNION SELECT r.node, t.b FROM reach r JOIN sides t ON t.a = r.other),
groups AS (SELECT node, least(node, min(other)) AS component_id FROM reach GROUP BY node)"""

COVER_TREE_SQL = f"""
WITH RECURSIVE vectors AS MATERIALIZED (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
    SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y ON x.label = y.label AND x.vec_id < y.vec_id
    WHERE list_dot_product(x.v, y.v) / (sqrt(list_dot_product(x.v, x.v)) * sqrt(list_dot_product(y.v, y.v))) >= 0.98
), {COMPONENTS}, counts AS (SELECT a AS node, CAST(count(*) AS BIGINT) AS n FROM sides GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, coalesce(g.component_id, e.vec_id) AS component_id,
       coalesce(g.component_id, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN counts c ON c.node = e.vec_id LEFT JOIN groups g ON g.node = e.vec_id
"""

NGRAM_JOIN_SQL = rf"""
WITH RECURSIVE lists AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS MATERIALIZED (
    SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
    FROM lists
), tokens AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
links AS MATERIALIZED (
    SELECT x.doc_id AS a, y.doc_id AS b FROM tokens x JOIN tokens y ON x.t = y.t AND x.doc_id < y.doc_id
    GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))
), {COMPONENTS}
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(g.component_id, s.doc_id) AS component_id
FROM sets s LEFT JOIN groups g ON g.node = s.doc_id
"""

ORACLES: dict[str, str] = {
    "op2_cover_tree": COVER_TREE_SQL,
    "op4_ngram_join": NGRAM_JOIN_SQL,
    "op5_entropy_mix": MIX_SQL,
    "op12_mean_search": CLUSTER_SQL,
    "op13_fill_in_middle": FILL_SQL,
}
