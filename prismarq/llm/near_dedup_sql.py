"""SQL for op5: sets, links and their closure, by joining shingles (for small tables; it compares all that share one)."""

ORACLE_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 2 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM d),
n AS (SELECT DISTINCT doc_id, len(s) AS n, s FROM g WHERE doc_id IS NOT NULL AND len(s) > 0),
x AS (SELECT doc_id, n, unnest(s) AS k FROM n),
link AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.k = b.k AND a.doc_id < b.doc_id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
pairs AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT doc_id AS v, doc_id AS r FROM n UNION SELECT pairs.a, reach.r FROM reach JOIN pairs ON reach.v = pairs.b AND reach.r < pairs.a),
c AS (SELECT v, min(r) AS component_id FROM reach GROUP BY v)
SELECT g.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(c.component_id, g.doc_id) AS component_id, coalesce(g.doc_id = coalesce(c.component_id, g.doc_id), true) AS kept FROM g LEFT JOIN c ON g.doc_id = c.v"""
