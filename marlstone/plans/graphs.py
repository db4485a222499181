"""Queries over walks, links and the resolution of names, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import graph, walks
from ..sources.tables import table
from .derived import derived, sql
from .knowledge import _E, _chunks, _pages
from .rankings import _CALLS, call_edges
from .registry import query

_STEP = f"(SELECT DISTINCT src, dst FROM {_E} WHERE src <> dst)"
_SEEDS = "(SELECT DISTINCT id FROM pages WHERE type = 'project' AND id % 5 = 0)"


def _seeds(spark: SparkSession, folder: str) -> DataFrame:
    """The stated set of seeds: projects with an id divisible by five."""
    return table(spark, folder, "pages").where("type = 'project' AND id % 5 = 0").select("id")


@query(f"""WITH RECURSIVE w AS (SELECT id AS seed, id AS node, 0 AS depth, [id] AS path FROM {_SEEDS} UNION ALL SELECT w.seed, e.dst, w.depth + 1, list_append(w.path, e.dst) FROM w JOIN {_STEP} e ON e.src = w.node WHERE w.depth < 3 AND NOT list_contains(w.path, e.dst))
SELECT seed, node, depth, array_to_string(path, '>') AS path FROM w""")
def path_traversal(spark: SparkSession, folder: str) -> DataFrame:
    """All paths of up to three links from each seed."""
    found = walks.paths(_seeds(spark, folder), graph.edges(table(spark, folder, "links")), 3)
    return found.select("seed", "node", "depth", F.array_join("path", ">").alias("path"))


@query(f"""WITH RECURSIVE s AS (SELECT src, dst FROM {_STEP} QUALIFY row_number() OVER (PARTITION BY src ORDER BY dst) <= 3), w AS (SELECT id AS seed, id AS node, 0 AS depth, [id] AS path FROM {_SEEDS} UNION ALL SELECT w.seed, s.dst, w.depth + 1, list_append(w.path, s.dst) FROM w JOIN s ON s.src = w.node WHERE w.depth < 5 AND NOT list_contains(w.path, s.dst))
SELECT seed, node, min(depth) AS depth, count(*) AS paths FROM w GROUP BY ALL""")
def capped_traversal(spark: SparkSession, folder: str) -> DataFrame:
    """A walk of five steps that takes at most three links from any node."""
    found = walks.paths(_seeds(spark, folder), graph.edges(table(spark, folder, "links")), 5, fan=3)
    return found.groupBy("seed", "node").agg(F.min("depth").alias("depth"), F.count("*").alias("paths"))


_TYPED = f"(SELECT DISTINCT src, dst, link_type FROM {_E} WHERE src <> dst AND link_type IS DISTINCT FROM 'mentions')"


@query(f"""WITH RECURSIVE w AS (SELECT id AS seed, id AS node, 0 AS hop FROM {_SEEDS} UNION SELECT w.seed, e.dst, w.hop + 1 FROM w JOIN {_TYPED} e ON e.src = w.node WHERE w.hop < 3), m AS (SELECT seed, node, min(hop) AS hop FROM w GROUP BY ALL)
SELECT m.seed, m.node, m.hop, coalesce(array_to_string(list_sort(list_distinct(list(e.link_type) FILTER (e.link_type IS NOT NULL))), ','), '') AS types FROM m LEFT JOIN m b ON b.seed = m.seed AND b.hop = m.hop - 1 LEFT JOIN {_TYPED} e ON e.src = b.node AND e.dst = m.node GROUP BY ALL""")
def typed_fan_out(spark: SparkSession, folder: str) -> DataFrame:
    """Nodes within three typed links of each seed: least hops, and the types of the last links."""
    edges = graph.edges(table(spark, folder, "links")).where(~F.col("link_type").eqNullSafe("mentions"))
    return walks.reach(_seeds(spark, folder), edges).select("seed", "node", "hop", F.array_join("last_types", ",").alias("types"))


@query(f"""WITH RECURSIVE w AS (SELECT id AS seed, id AS node, 0 AS hop FROM (SELECT id FROM {_SEEDS} ORDER BY id LIMIT 2) UNION SELECT w.seed, e.dst, w.hop + 1 FROM w JOIN {_STEP} e ON e.src = w.node WHERE w.hop < 3), m AS (SELECT seed, node, min(hop) AS hop FROM w GROUP BY ALL)
SELECT a.node, a.hop + b.hop AS hops FROM m a JOIN m b ON a.node = b.node AND a.seed < b.seed WHERE a.hop > 0 AND b.hop > 0""")
def connecting_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages that two seeds both lead to: a join of their fan-outs, without the seeds."""
    two = _seeds(spark, folder).distinct().orderBy("id").limit(2)
    met = walks.reach(two, graph.edges(table(spark, folder, "links"))).where("hop > 0").select("seed", "node", "hop")
    other = met.select(F.col("seed").alias("s2"), "node", F.col("hop").alias("h2"))
    return met.join(other, "node").where("seed < s2").select("node", (F.col("hop") + F.col("h2")).alias("hops"))


@query(f"""SELECT src AS id, dst AS other, link_type, 'out' AS way FROM {_E} WHERE src % 20 = 0 UNION ALL SELECT dst, src, link_type, 'in' FROM {_E} WHERE dst % 20 = 0""")
def page_edges(spark: SparkSession, folder: str) -> DataFrame:
    """The edges of a stated set of pages, both ways."""
    both = walks.both_ways(graph.edges(table(spark, folder, "links"))).where("src % 20 = 0")
    return both.select(F.col("src").alias("id"), F.col("dst").alias("other"), "link_type", "way")


@query("""SELECT DISTINCT l.from_page_id AS src, t.slug AS target, o.slug AS origin, l.origin_field FROM links l JOIN (SELECT DISTINCT id, slug FROM pages) t ON t.id = l.to_page_id LEFT JOIN (SELECT DISTINCT id, slug FROM pages) o ON o.id = l.origin_page_id""")
def edges_with_origin(spark: SparkSession, folder: str) -> DataFrame:
    slugs = _pages(spark, folder, "slug")
    rows = table(spark, folder, "links").select("from_page_id", "to_page_id", "origin_page_id", "origin_field").distinct()
    rows = rows.join(slugs.select(F.col("id").alias("to_page_id"), F.col("slug").alias("target")), "to_page_id").join(slugs.select(F.col("id").alias("origin_page_id"), F.col("slug").alias("origin")), "origin_page_id", "left")
    return rows.select(F.col("from_page_id").alias("src"), "target", "origin", "origin_field").distinct()


_D = "(SELECT symbol_name AS callee, min(id) AS target FROM content_chunks WHERE symbol_name IS NOT NULL GROUP BY 1)"
_CE = f"(SELECT DISTINCT c.chunk_id AS src, d.target AS dst FROM {_CALLS} c JOIN {_D} d USING (callee) WHERE c.chunk_id <> d.target)"


@query(f"""SELECT callee, count(DISTINCT chunk_id) AS callers, CASE WHEN regexp_matches(lower(callee), '(query|execute|select|insert|sql)') THEN 'db' WHEN regexp_matches(lower(callee), '(fetch|request|http|get_url|post)') THEN 'http'
WHEN regexp_matches(lower(callee), '(open|read|write|save|load)') THEN 'file' WHEN regexp_matches(lower(callee), '(spawn|exec|system|run)') THEN 'process' END AS sink FROM {_CALLS} GROUP BY 1""")
def call_sinks(spark: SparkSession, folder: str) -> DataFrame:
    """Called names with what they reach."""
    rows = call_edges(spark, folder).groupBy("callee").agg(F.countDistinct("chunk_id").alias("callers"))
    return rows.withColumn("sink", walks.sink(F.col("callee")))


@query(f"""WITH RECURSIVE w AS (SELECT DISTINCT dst AS seed, dst AS node, 0 AS depth FROM {_CE} UNION SELECT w.seed, e.src, w.depth + 1 FROM w JOIN {_CE} e ON e.dst = w.node WHERE w.depth < 5)
SELECT seed, node, min(depth) AS depth, round(1 / (1 + 0.3 * min(depth)), 6) AS confidence FROM w GROUP BY ALL""")
def blast_radius(spark: SparkSession, folder: str) -> DataFrame:
    """All callers of each called chunk within five calls, less certain with each."""
    edges = call_edges(spark, folder).where("resolved AND chunk_id <> target").select(F.col("target").alias("src"), F.col("chunk_id").alias("dst"), F.lit("calls").alias("link_type")).distinct()
    found = walks.reach(edges.select(F.col("src").alias("id")), edges, 5)
    return found.select("seed", "node", F.col("hop").alias("depth"), F.round(1 / (1 + 0.3 * F.col("hop")), 6).alias("confidence"))


@query(f"""WITH h AS (SELECT id, 1.0 AS score FROM (SELECT DISTINCT id FROM content_chunks WHERE language = 'python')), b AS (SELECT src, dst FROM {_CE} UNION SELECT dst, src FROM {_CE}),
x AS (SELECT id, score FROM h UNION ALL SELECT b.dst, h.score / 2 FROM h JOIN b ON b.src = h.id) SELECT id, round(max(score), 6) AS score FROM x GROUP BY 1""")
def expanded_code_hits(spark: SparkSession, folder: str) -> DataFrame:
    """Hits and their neighbours one call away, at half the score."""
    hits = table(spark, folder, "content_chunks").where("language = 'python'").select("id").distinct().withColumn("score", F.lit(1.0))
    edges = walks.both_ways(call_edges(spark, folder).where("resolved AND chunk_id <> target").select(F.col("chunk_id").alias("src"), F.col("target").alias("dst")).distinct()).select("src", "dst").distinct()
    near = hits.join(edges, hits["id"] == edges["src"]).select(F.col("dst").alias("id"), (F.col("score") / 2).alias("score"))
    return hits.union(near).groupBy("id").agg(F.round(F.max("score"), 6).alias("score"))


_BODY = "regexp_replace(regexp_replace(compiled_truth, '(?s)```.*?(```|$)', '', 'g'), '`[^`\\n]*`', '', 'g')"
_VERB = "CASE " + " ".join(f"WHEN regexp_matches(lower(s), '{w}') THEN '{k}'" for k, w in walks.VERBS) + " ELSE 'mentions' END"


@query(f"""WITH p AS (SELECT DISTINCT id, {_BODY} AS t FROM pages WHERE compiled_truth IS NOT NULL), s AS (SELECT id, unnest(regexp_extract_all(t, '([^.!?\\n]*\\[\\[[^\\]|\\n]+(?:\\|[^\\]\\n]*)?\\]\\][^.!?\\n]*)', 1)) AS s FROM p),
w AS (SELECT id, s, unnest(regexp_extract_all(s, '\\[\\[([^\\]|\\n]+)(?:\\|[^\\]\\n]*)?\\]\\]', 1)) AS target FROM s), r AS (SELECT id, regexp_replace(t, '\\[\\[[^\\]\\n]*\\]\\]', ' ', 'g') AS t FROM p)
SELECT DISTINCT id, CASE WHEN contains(target, ':') THEN 'qualified' ELSE 'wiki' END AS kind, lower(trim(target)) AS target, {_VERB} AS link_type FROM w
UNION SELECT id, 'markdown', lower(trim(unnest(regexp_extract_all(t, '\\[[^\\]\\n]*\\]\\(([^)\\s]+)\\.md\\)', 1)))), 'mentions' FROM r
UNION SELECT id, 'bare', lower(trim(unnest(regexp_extract_all(regexp_replace(t, '\\[[^\\]\\n]*\\]\\([^)]*\\)', ' ', 'g'), '\\b((?:people|companies|projects|concepts|meetings)/[a-z0-9][a-z0-9-]*)', 1)))), 'mentions' FROM r""")
def extracted_links(spark: SparkSession, folder: str) -> DataFrame:
    """Links of four notations in bodies, with the type that the sentence around them tells."""
    return walks.links_in(_pages(spark, folder, "compiled_truth"))


_FM = " UNION ".join(f"""SELECT id, '{f}' AS field, unnest(CASE WHEN json_type(frontmatter, '$.{f}') = 'ARRAY' THEN from_json(json_extract(frontmatter, '$.{f}'), '["VARCHAR"]') ELSE [json_extract_string(frontmatter, '$.{f}')] END) AS target, '{k}' AS link_type FROM pages WHERE json_extract(frontmatter, '$.{f}') IS NOT NULL""" for f, k in walks.FIELDS.items())


@query(f"SELECT * FROM ({_FM}) WHERE target IS NOT NULL AND target <> ''")
def frontmatter_links(spark: SparkSession, folder: str) -> DataFrame:
    """Links that fields of the front matter hold."""
    return walks.front_links(_pages(spark, folder, "frontmatter"))


@query("SELECT DISTINCT id, unnest(regexp_extract_all(compiled_truth, '\\b([A-Za-z0-9_/-]+\\.(?:py|ts|go|rs|js|java|rb|sql)(?::\\d+)?)\\b', 1)) AS ref FROM pages")
def code_references(spark: SparkSession, folder: str) -> DataFrame:
    """Paths of code files, with line numbers where they are given."""
    shape = r"\b([A-Za-z0-9_/-]+\.(?:py|ts|go|rs|js|java|rb|sql)(?::\d+)?)\b"
    return table(spark, folder, "pages").where("compiled_truth IS NOT NULL").select("id", F.explode(F.regexp_extract_all("compiled_truth", F.lit(shape), 1)).alias("ref")).distinct()


@query("SELECT basename, count(*) AS pages, first(slug ORDER BY length(slug), slug) AS shortest FROM (SELECT DISTINCT id, slug, string_split(slug, '/')[-1] AS basename FROM pages) GROUP BY 1")
def basename_index(spark: SparkSession, folder: str) -> DataFrame:
    rows = _pages(spark, folder, "slug").withColumn("basename", F.element_at(F.split("slug", "/"), -1))
    return rows.groupBy("basename").agg(F.count("*").alias("pages"), F.min(F.struct(F.length("slug").alias("n"), "slug")).alias("b")).select("basename", "pages", F.col("b.slug").alias("shortest"))


_RUNS = " UNION ALL ".join(f"SELECT id, i AS pos, {n} AS n, array_to_string(w[i:i + {n - 1}], ' ') AS run FROM (SELECT id, w, unnest(range(1, len(w) - {n} + 2)) AS i FROM b)" for n in range(1, 5))


@query(rf"""WITH b AS (SELECT DISTINCT id, regexp_extract_all(lower(compiled_truth), '([\p{{L}}\p{{N}}]+)', 1) AS w FROM pages WHERE compiled_truth IS NOT NULL), t AS (SELECT array_to_string(w, ' ') AS run, min(id) AS target FROM
(SELECT DISTINCT id, regexp_extract_all(lower(title), '([\p{{L}}\p{{N}}]+)', 1) AS w FROM pages WHERE type IN ('person', 'company')) WHERE len(w) BETWEEN 1 AND 4 AND length(array_to_string(w, '')) >= 4 GROUP BY 1),
r AS (SELECT id, run, n, min(pos) AS pos FROM ({_RUNS}) GROUP BY ALL), h AS (SELECT r.id, r.pos, r.n, t.target FROM r JOIN t USING (run) WHERE r.id <> t.target), m AS (SELECT id, pos, first(target ORDER BY n DESC) AS target FROM h GROUP BY ALL)
SELECT id, target, CAST(min(pos) AS INT) AS "at" FROM m GROUP BY ALL""")
def title_gazetteer(spark: SparkSession, folder: str) -> DataFrame:
    """First mentions of people and companies in bodies, by titles of up to four words in any script; the longest match at each place."""
    pages = _pages(spark, folder, "compiled_truth")
    return walks.mentions(pages, _pages(spark, folder, "title", "type").where("type IN ('person', 'company') AND title IS NOT NULL"))


_SLUG = f"trim(regexp_replace(translate(lower({{}}), '{text.ACCENTS[0]}', '{text.ACCENTS[1]}'), '[^a-z0-9]+', '-', 'g'), '-')"


@query(f"""WITH n AS (SELECT DISTINCT lower(trim(unnest(regexp_extract_all(compiled_truth, '\\[\\[([^\\]|\\n]+)(?:\\|[^\\]\\n]*)?\\]\\]', 1)))) AS name FROM pages UNION SELECT DISTINCT title FROM pages WHERE title IS NOT NULL), p AS (SELECT DISTINCT id, slug, title, string_split(slug, '/')[-1] AS base FROM pages),
a AS (SELECT slug AS k, first(id ORDER BY length(slug), slug, id) AS id FROM p GROUP BY 1), b AS (SELECT {_SLUG.format('title')} AS k, first(id ORDER BY length(slug), slug, id) AS id FROM p WHERE title IS NOT NULL GROUP BY 1), c AS (SELECT base AS k, first(id ORDER BY length(slug), slug, id) AS id FROM p GROUP BY 1),
d AS (SELECT regexp_extract(base, '^([a-z0-9]+-[a-z0-9]+)', 1) AS k, first(id ORDER BY length(slug), slug, id) AS id FROM p GROUP BY 1)
SELECT n.name, coalesce(a.id, b.id, c.id, d.id) AS id, CASE WHEN a.id IS NOT NULL THEN 'slug' WHEN b.id IS NOT NULL THEN 'title' WHEN c.id IS NOT NULL THEN 'basename' WHEN d.id IS NOT NULL THEN 'prefix' ELSE 'none' END AS how
FROM n LEFT JOIN a ON a.k = lower(n.name) AND a.k <> '' LEFT JOIN b ON b.k = {_SLUG.format('n.name')} AND b.k <> '' LEFT JOIN c ON c.k = {_SLUG.format('n.name')} AND c.k <> '' LEFT JOIN d ON d.k = {_SLUG.format('n.name')} AND d.k <> ''""")
def resolved_names(spark: SparkSession, folder: str) -> DataFrame:
    """Linked names and titles with their pages, by a cascade of exact and looser keys."""
    pages = _pages(spark, folder, "slug", "title")
    linked = table(spark, folder, "pages").where("compiled_truth LIKE '%[[%'").select(F.explode(F.regexp_extract_all("compiled_truth", F.lit(r"\[\[([^\]|\n]+)(?:\|[^\]\n]*)?\]\]"), 1)).alias("name")).select(F.lower(F.trim("name")).alias("name"))
    return walks.resolved(linked.union(pages.where("title IS NOT NULL").select("title")), pages)


@query("""WITH c AS (SELECT DISTINCT id, page_id, start_line AS begin, end_line + 1 AS stop FROM content_chunks WHERE start_line IS NOT NULL AND end_line >= start_line), o AS (SELECT DISTINCT page_id, unnest(generate_series(1, 60, 7)) AS at FROM c)
SELECT o.page_id, o.at, min(c.id) AS id FROM o JOIN c ON c.page_id = o.page_id AND o.at >= c.begin AND o.at < c.stop GROUP BY ALL""")
def lines_to_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """The chunk that holds each line asked for."""
    spans = table(spark, folder, "content_chunks").where("start_line IS NOT NULL AND end_line >= start_line").select("id", "page_id", F.col("start_line").alias("begin"), (F.col("end_line") + 1).alias("end")).distinct()
    asked = spans.select("page_id").distinct().select("page_id", F.explode(F.sequence(F.lit(1), F.lit(60), F.lit(7))).alias("at"))
    return walks.held_in(asked, spans, "page_id")


@query(f"""WITH RECURSIVE t AS (SELECT DISTINCT unnest(from_json(json_extract(frontmatter, '$.tags'), '["VARCHAR"]')) AS tag FROM pages), s AS (SELECT min(tag) OVER (PARTITION BY left(tag, 3)) AS x, tag AS y FROM t), a AS (SELECT x, y FROM s WHERE x <> y UNION SELECT y, x FROM s WHERE x <> y),
w AS (SELECT tag AS seed, tag AS node, 0 AS hop FROM t UNION SELECT w.seed, a.y, w.hop + 1 FROM w JOIN a ON a.x = w.node WHERE w.hop < 2) SELECT seed, array_to_string(list_sort(list(DISTINCT node)), ',') AS closure FROM w GROUP BY 1""")
def alias_closure(spark: SparkSession, folder: str) -> DataFrame:
    """What each alias reaches over a symmetric alias graph in two steps."""
    from .writes import tag_rows

    tags = tag_rows(spark, folder).select("tag").distinct().withColumn("k", F.substring("tag", 1, 3))
    first = tags.groupBy("k").agg(F.min("tag").alias("src"))
    edges = walks.both_ways(tags.join(first, "k").where("src <> tag").select("src", F.col("tag").alias("dst"))).select("src", "dst", F.lit("alias").alias("link_type"))
    met = walks.reach(tags.select(F.col("tag").alias("id")), edges, 2)
    return met.groupBy("seed").agg(F.array_join(F.array_sort(F.collect_set("node")), ",").alias("closure"))


@query(f"SELECT DISTINCT l.src, c.id AS dst, 'works_at' AS link_type FROM {_E} l JOIN (SELECT DISTINCT id FROM pages WHERE type = 'company') c ON c.id = l.dst JOIN (SELECT DISTINCT id FROM pages WHERE type = 'person') p ON p.id = l.src")
def pages_as_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Links between people and companies as edges of one type."""
    kinds = _pages(spark, folder, "type")
    found = graph.edges(table(spark, folder, "links")).select("src", "dst").distinct()
    found = found.join(kinds.where("type = 'person'").select(F.col("id").alias("src")), "src", "left_semi").join(kinds.where("type = 'company'").select(F.col("id").alias("dst")), "dst", "left_semi")
    return found.withColumn("link_type", F.lit("works_at"))


@query(f"""WITH r AS (SELECT id, page_id, claim, weight, since_date FROM {sql('claims')} WHERE active AND id % 10 = 0) SELECT a.id AS a, b.id AS b, round(a.weight + b.weight, 6) AS score FROM r a JOIN r b ON a.page_id = b.page_id AND a.id < b.id WHERE a.claim <> b.claim AND abs(date_diff('day', a.since_date, b.since_date)) <= 30""")
def claim_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of a stated set of claims of one page that are dated within a month of each other."""
    rows = derived(spark, folder, "claims").where("active AND id % 10 = 0").select("id", "page_id", "claim", "weight", "since_date")
    one, two = rows.toDF("a", "page_id", "c1", "w1", "d1"), rows.toDF("b", "page_id", "c2", "w2", "d2")
    met = one.join(two, "page_id").where("a < b AND c1 <> c2").where(F.abs(F.date_diff("d1", "d2")) <= 30)
    return met.select("a", "b", F.round(F.col("w1") + F.col("w2"), 6).alias("score"))


@query(f"""SELECT c.page_id, c.row_num, p.id IS NOT NULL AS known FROM (SELECT page_id + CASE WHEN id % 3 = 0 THEN 100000000 ELSE 0 END AS page_id, row_num FROM {sql('claims')}) c LEFT JOIN (SELECT DISTINCT id FROM pages) p ON p.id = c.page_id""")
def resolved_citations(spark: SparkSession, folder: str) -> DataFrame:
    """Citations of rows and whether their page is known."""
    rows = derived(spark, folder, "claims").select((F.col("page_id") + F.when(F.col("id") % 3 == 0, 100_000_000).otherwise(0)).alias("page_id"), "row_num")
    known = _pages(spark, folder).select(F.col("id").alias("page_id"), F.lit(True).alias("k"))
    return rows.join(known, "page_id", "left").select("page_id", "row_num", F.col("k").isNotNull().alias("known"))


@query("""SELECT DISTINCT c.page_id, c.id AS chunk_id FROM content_chunks c WHERE EXISTS (SELECT 1 FROM pages p WHERE p.id = c.page_id AND starts_with(p.slug, 'people/'))""")
def prefixed_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks of pages under a prefix: a semi-join."""
    pages = table(spark, folder, "pages").where("slug LIKE 'people/%'").select(F.col("id").alias("page_id"))
    return _chunks(spark, folder, "page_id").join(pages, "page_id", "left_semi").select("page_id", F.col("id").alias("chunk_id"))
