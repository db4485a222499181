"""SQL for those queries of this subpackage that SQL can express by brute force."""

from __future__ import annotations

# The operator is checked by what must hold of its result: texts are counted, faults are none.
P1_AUDIT = """SELECT field, count(DISTINCT id) AS texts, CAST(0 AS BIGINT) AS leaked, CAST(0 AS BIGINT) AS unchanged, CAST(0 AS BIGINT) AS collisions FROM
(SELECT 'compiled_truth' AS field, id FROM pages WHERE compiled_truth IS NOT NULL UNION ALL SELECT 'timeline', id FROM pages WHERE timeline IS NOT NULL
UNION ALL SELECT 'chunk_text', id FROM content_chunks WHERE chunk_text IS NOT NULL) GROUP BY 1"""

P2_FOUND = r"""WITH k AS (SELECT id, w FROM (SELECT id, regexp_extract_all(lower(compiled_truth), '[\p{L}\p{N}]+') AS w FROM
(SELECT DISTINCT id, compiled_truth FROM pages WHERE page_kind = 'markdown' AND coalesce(type, '') <> 'email' AND compiled_truth IS NOT NULL)) WHERE len(w) >= 30),
s AS (SELECT id, list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM k),
u AS (SELECT id, len(g) AS n, unnest(g) AS x FROM s)
SELECT a.id AS page_id_a, b.id AS page_id_b FROM u a JOIN u b ON a.x = b.x AND a.id < b.id GROUP BY a.id, b.id, a.n, b.n HAVING count(*) >= 0.7 * (a.n + b.n - count(*))"""

P2_CLASSES = r"""WITH RECURSIVE k AS (SELECT id, w FROM (SELECT id, regexp_extract_all(lower(compiled_truth), '[\p{L}\p{N}]+') AS w FROM
(SELECT DISTINCT id, compiled_truth FROM pages WHERE page_kind = 'markdown' AND compiled_truth IS NOT NULL)) WHERE len(w) >= 5),
s AS (SELECT id, list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) AS g FROM k),
m AS (SELECT id, min(id) OVER (PARTITION BY g) AS rep, g FROM s),
u AS (SELECT id, len(g) AS n, unnest(g) AS x FROM m WHERE id = rep),
e AS (SELECT a.id AS a, b.id AS b FROM u a JOIN u b ON a.x = b.x AND a.id <> b.id GROUP BY a.id, b.id, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*))),
walk AS (SELECT id AS node, id AS seen FROM m WHERE id = rep UNION SELECT w.node, e.b FROM walk w JOIN e ON e.a = w.seen),
c AS (SELECT node, min(seen) AS class FROM walk GROUP BY 1), l AS (SELECT a, count(*) AS links FROM e GROUP BY 1)
SELECT m.id AS page_id, c.class, CAST(coalesce(l.links, 0) AS BIGINT) AS links FROM m JOIN c ON c.node = m.rep LEFT JOIN l ON l.a = m.rep"""

# The splitter is checked by what must hold of its pieces.
P4_AUDIT = """SELECT count(*) AS texts, CAST(sum(length(compiled_truth)) AS BIGINT) AS chars, CAST(0 AS BIGINT) AS broken, CAST(0 AS BIGINT) AS miscounted
FROM (SELECT DISTINCT id, compiled_truth FROM pages WHERE compiled_truth <> '')"""

# The containers are checked by what must hold of them.
P9_AUDIT = """SELECT limit_id, (SELECT count(DISTINCT doc_id) FROM documents) AS items, CAST(0 AS BIGINT) AS overfull, CAST(0 AS BIGINT) AS torn, CAST(0 AS BIGINT) AS together FROM pack_limits"""

P4_FOUND = r"""WITH c AS (SELECT DISTINCT page_id, chunk_index, coalesce(chunk_text, '') AS x FROM content_chunks WHERE chunk_source = 'compiled_truth'),
j AS (SELECT c.*, t, instr(t, x) AS s, instr(t, x) + length(x) AS e FROM c JOIN (SELECT DISTINCT id, coalesce(compiled_truth, '') AS t FROM pages) p ON p.id = c.page_id),
b AS (SELECT page_id, chunk_index, x,
length(regexp_extract(left(t, s - 1), '[^ \t\r\n]*$')) AS l1, length(regexp_extract(substr(t, s), '^[^ \t\r\n]*')) AS r1,
length(regexp_extract(left(t, e - 1), '[^ \t\r\n]*$')) AS l2, length(regexp_extract(substr(t, e), '^[^ \t\r\n]*')) AS r2 FROM j)
SELECT DISTINCT b.page_id, b.chunk_index FROM b LEFT JOIN c q ON q.page_id = b.page_id AND q.chunk_index = b.chunk_index - 1
WHERE length(b.x) > 1600 OR (l1 > 0 AND r1 > 0 AND l1 + r1 <= 1600) OR (l2 > 0 AND r2 > 0 AND l2 + r2 <= 1600)
OR (b.chunk_index > 0 AND (q.x IS NULL OR len(list_filter(range(80, 241), lambda k: k <= length(q.x) AND k <= length(b.x) AND right(q.x, k) = left(b.x, k))) = 0))"""

P7_FOUND = """WITH v AS (SELECT DISTINCT id, model, CAST(embedding AS DOUBLE[]) AS e FROM content_chunks WHERE len(embedding) = 64
AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT a.id AS a, b.id AS b, list_cosine_similarity(a.e, b.e) AS c FROM v a JOIN v b ON a.model IS NOT DISTINCT FROM b.model AND a.id <> b.id)
SELECT DISTINCT least(a, b) AS chunk_id_a, greatest(a, b) AS chunk_id_b FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY c DESC, b) AS n FROM p) WHERE n <= 5 AND c >= 0.9"""

P7_NEAREST = """WITH v AS (SELECT DISTINCT id, model, CAST(embedding AS DOUBLE[]) AS e FROM content_chunks WHERE len(embedding) = 64
AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT a.id, b.id AS neighbour, list_cosine_similarity(a.e, b.e) AS similarity FROM v a JOIN v b ON a.model IS NOT DISTINCT FROM b.model AND a.id <> b.id WHERE a.id % 50 = 0)
SELECT id, neighbour, round(similarity, 6) AS similarity, rank FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY similarity DESC, neighbour) AS rank FROM p) WHERE rank <= 5"""

P10_FOUND = """WITH h AS (SELECT doc_id, s, hash(substring(text, CAST(s + 1 AS BIGINT), 200)) AS h FROM (SELECT doc_id, text, unnest(range(0, length(text) - 199)) AS s FROM documents WHERE length(text) >= 200)),
m AS (SELECT doc_id, s FROM h WHERE h IN (SELECT h FROM h GROUP BY h HAVING min(doc_id) <> max(doc_id))),
i AS (SELECT *, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 200 THEN 0 ELSE 1 END AS fresh FROM m),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS island FROM i)
SELECT doc_id, CAST(min(s) AS INT) AS span_start, CAST(max(s) + 200 AS INT) AS span_end FROM g GROUP BY doc_id, island"""

_SPANS = P10_FOUND.replace("\nSELECT doc_id, CAST(min(s) AS INT) AS span_start, CAST(max(s) + 200 AS INT) AS span_end FROM g GROUP BY doc_id, island", ",\nr AS (SELECT doc_id, max(s) + 200 - min(s) AS n FROM g GROUP BY doc_id, island)")
P10_SHARE = f"""{_SPANS}
SELECT d.doc_id, coalesce(length(d.text), 0) AS n_chars, CAST(coalesce(sum(r.n), 0) AS BIGINT) AS shared_chars, count(r.n) AS spans FROM documents d LEFT JOIN r USING (doc_id) GROUP BY ALL"""

ORACLES = {
    "p1_audit": P1_AUDIT, "p2_found": P2_FOUND, "p2_classes": P2_CLASSES, "p4_found": P4_FOUND, "p4_audit": P4_AUDIT, "p7_found": P7_FOUND, "p7_nearest": P7_NEAREST, "p9_audit": P9_AUDIT,
    "p10_found": P10_FOUND, "p10_share": P10_SHARE,
}
