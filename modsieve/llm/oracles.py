"""SQL twins of the queries that SQL can express on whole tables."""

from __future__ import annotations

_SPACED = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(pattern: str, lower: bool) -> str:
    text = "coalesce(text, '')"
    if lower:
        text = f"translate({text}, '{_UPPER}', '{_LOWER}')"
    return f"regexp_extract_all({text}, '{pattern}')"


def _reach(links: str, nodes: str) -> str:
    """Smallest node reachable over ``links(a, b)``, as ``reached(x, component_id)``."""
    return f"""
    ties AS (SELECT a, b FROM {links} UNION SELECT b, a FROM {links}),
    walk(x, y) AS (SELECT id, id FROM {nodes} UNION SELECT walk.x, ties.b FROM walk JOIN ties ON walk.y = ties.a),
    reached AS (SELECT x, min(y) AS component_id FROM walk GROUP BY x)"""


OP6 = f"""
WITH RECURSIVE v AS (
  SELECT vec_id AS id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT p.id AS a, q.id AS b FROM v p JOIN v q ON p.id < q.id AND len(p.e) = len(q.e)
          WHERE list_cosine_similarity(p.e, q.e) >= 0.95),
nodes AS (SELECT vec_id AS id FROM embeddings),
{_reach("links", "nodes")}
SELECT e.vec_id, (SELECT count(*) FROM ties WHERE ties.a = e.vec_id) AS n_links, component_id,
       component_id = e.vec_id AS kept
FROM embeddings e JOIN reached ON reached.x = e.vec_id
"""

OP7 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_words(_SPACED, True)} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
      ELSE list_distinct([array_to_string(w[i : i + 3], ' ') FOR i IN range(1, len(w) - 2)]) END AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
links AS (SELECT p.doc_id AS a, q.doc_id AS b FROM e p JOIN e q ON p.g = q.g AND p.doc_id < q.doc_id
          GROUP BY p.doc_id, q.doc_id, p.n, q.n HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))),
nodes AS (SELECT doc_id AS id FROM documents),
{_reach("links", "nodes")}
SELECT s.doc_id, len(s.s) AS n_shingles, component_id FROM s JOIN reached ON reached.x = s.doc_id
"""

OP8 = f"""
WITH w AS (SELECT doc_id, {_words(_SPACED, False)} AS w FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS i,
             unnest([array_to_string(w[j : j + 19], ' ') FOR j IN range(1, len(w) - 18)]) AS g FROM w),
later AS (SELECT doc_id, i FROM g QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1),
gone AS (SELECT doc_id, list(DISTINCT p) AS gone FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM later) GROUP BY doc_id),
k AS (SELECT w.doc_id, w.w, coalesce(gone.gone, []) AS gone FROM w LEFT JOIN gone ON w.doc_id = gone.doc_id),
kept AS (SELECT k.doc_id, string_agg(x, ' ' ORDER BY k.i) AS kept FROM (
           SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM k) k
         LEFT JOIN (SELECT doc_id, unnest(gone) AS i, true AS out FROM gone) o ON k.doc_id = o.doc_id AND k.i = o.i
         WHERE o.out IS NULL GROUP BY k.doc_id)
SELECT k.doc_id, len(k.w) AS n_words, len(k.gone)::BIGINT AS n_removed, sha256(coalesce(kept.kept, '')) AS kept_sha256
FROM k LEFT JOIN kept ON k.doc_id = kept.doc_id
"""

OP9 = f"""
WITH w AS (SELECT doc_id, {_words(_ALNUM, True)} AS w FROM documents),
b AS (SELECT item_id, w, least(13, len(w)) AS n FROM (SELECT item_id, {_words(_ALNUM, True)} AS w FROM benchmark) WHERE len(w) > 0),
known AS (SELECT DISTINCT item_id, n, unnest([array_to_string(w[j : j + n - 1], ' ') FOR j IN range(1, len(w) - n + 2)]) AS g FROM b),
sizes AS (SELECT DISTINCT n FROM known),
g AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i,
             unnest([array_to_string(w[j : j + n - 1], ' ') FOR j IN range(1, len(w) - n + 2)]) AS g
      FROM w JOIN sizes ON len(w) >= n),
hits AS (SELECT doc_id, i, g.n, item_id FROM g JOIN known ON g.n = known.n AND g.g = known.g),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, list_sort(list(DISTINCT item_id::VARCHAR)) AS names FROM hits GROUP BY doc_id)
SELECT w.doc_id, len(w.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(array_to_string(coalesce(names, []), ',')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w.w) AS contaminated
FROM w LEFT JOIN words ON w.doc_id = words.doc_id LEFT JOIN items ON w.doc_id = items.doc_id
"""


def _codes(scale: int, more: str = "") -> str:
    """Sound vectors as whole numbers."""
    return f"""
    v AS (SELECT vec_id AS id{more}, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS c FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""


OP11 = f"""
WITH {_codes(64)},
s AS (SELECT q.id AS query_id, v.id AS vec_id, list_inner_product(q.c, v.c)::BIGINT AS score
      FROM v q JOIN v ON q.id <> v.id WHERE q.id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""

OP12 = f"""
WITH {_codes(256, ", CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label")},
s AS (SELECT a.id AS anchor_id, v.id, a.label = v.label AS same, list_inner_product(a.c, v.c)::BIGINT AS score
      FROM v a JOIN v ON a.id <> v.id WHERE a.id % 100 = 0 AND a.label IS NOT NULL AND v.label IS NOT NULL),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

OP13 = f"""
WITH t AS (SELECT doc_id, unnest({_words(_TERM, True)}) AS t FROM documents),
lengths AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
sums AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths),
tf AS (SELECT doc_id, t, count(*) AS tf FROM t GROUP BY doc_id, t),
w AS (SELECT t, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, sums GROUP BY t),
items AS (SELECT item_id, t, count(*) AS times FROM (SELECT item_id, unnest({_words(_TERM, True)}) AS t FROM benchmark) GROUP BY item_id, t),
s AS (SELECT item_id, doc_id,
             sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * docs) // terms)))))::BIGINT AS score
      FROM items JOIN tf USING (t) JOIN w USING (t) JOIN lengths USING (doc_id), sums GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 20
"""

SQL = {
    "op6_embeddings": OP6, "op7_jaccard": OP7, "op8_fm_index": OP8, "op9_decontaminate": OP9,
    "op11_maxscore": OP11, "op12_bond": OP12, "op13_lexical": OP13,
}
