"""Queries over pages, chunks, links, timelines and jobs, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scores, text
from ..operators import graph, pages as page_ops, search, vectors
from ..sources.tables import table
from .registry import query

#: The moment the queries call now.
NOW = "2026-01-01 00:00:00"
_P = "(SELECT DISTINCT * FROM pages)"
_C = "(SELECT DISTINCT * FROM content_chunks)"


def _pages(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Pages without repeated deliveries; only the columns asked for are read and compared."""
    return table(spark, folder, "pages").select("id", *columns).distinct()


def _chunks(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return table(spark, folder, "content_chunks").select("id", *columns).distinct()


# --- scans and filters ------------------------------------------------------------------------------


@query("SELECT DISTINCT source_id, slug FROM pages WHERE deleted_at IS NULL")
def page_refs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").where("deleted_at IS NULL").select("source_id", "slug").distinct()


@query("SELECT DISTINCT slug FROM pages")
def all_slugs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select("slug").distinct()


@query("SELECT id, name, archived FROM sources WHERE NOT coalesce(archived, false) AND local_path IS NOT NULL")
def local_sources(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "sources").where("NOT coalesce(archived, false) AND local_path IS NOT NULL").select("id", "name", "archived")


@query(f"""SELECT id, slug, type FROM {_P} WHERE type IN ('note', 'meeting') AND updated_at > TIMESTAMP '2025-01-01' AND NOT starts_with(slug, 'archive/')
ORDER BY updated_at DESC NULLS LAST, id LIMIT 50""")
def recent_notes(spark: SparkSession, folder: str) -> DataFrame:
    found = page_ops.listed(_pages(spark, folder, "slug", "type", "updated_at", "created_at"), ["note", "meeting"], "2025-01-01", without=["archive/"], limit=50)
    return found.select("id", "slug", "type")


@query("""SELECT DISTINCT p.id, p.type FROM pages p JOIN sources s ON s.id = p.source_id
WHERE p.deleted_at IS NULL AND NOT coalesce(s.archived, false) AND coalesce(json_extract_string(p.frontmatter, '$.quarantined'), 'false') <> 'true'""")
def visible_pages(spark: SparkSession, folder: str) -> DataFrame:
    return page_ops.visible(_pages(spark, folder, "source_id", "type", "deleted_at", "frontmatter"), table(spark, folder, "sources")).select("id", "type")


@query(f"""SELECT lower(content_hash) AS hash, count(*) AS copies, min(id) AS first_id, max(id) AS last_id FROM {_P}
WHERE content_hash IS NOT NULL GROUP BY 1 HAVING count(*) > 1""")
def duplicate_hashes(spark: SparkSession, folder: str) -> DataFrame:
    rows = _pages(spark, folder, "content_hash").where("content_hash IS NOT NULL")
    return rows.groupBy(F.lower("content_hash").alias("hash")).agg(F.count("*").alias("copies"), F.min("id").alias("first_id"), F.max("id").alias("last_id")).where("copies > 1")


@query(f"""SELECT id, content_hash IS NULL AS missing, lower(content_hash) IS DISTINCT FROM sha256(compiled_truth) AS stale
FROM {_P} WHERE compiled_truth IS NOT NULL AND lower(content_hash) IS DISTINCT FROM sha256(compiled_truth)""")
def stale_hashes(spark: SparkSession, folder: str) -> DataFrame:
    """Bodies are hashed on the scan; only ids and flags are made distinct."""
    stale = ~F.lower("content_hash").eqNullSafe(F.sha2("compiled_truth", 256))
    rows = table(spark, folder, "pages").where(F.col("compiled_truth").isNotNull() & stale)
    return rows.select("id", F.col("content_hash").isNull().alias("missing"), F.lit(True).alias("stale")).distinct()


@query(f"""SELECT chunk_source, model, count(*) AS chunks, count(*) FILTER (embedding IS NULL) AS missing, count(*) FILTER (embedding IS NULL OR model <> 'embed-large-v3') AS stale
FROM {_C} GROUP BY ALL""")
def embedding_backlog(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors are tested on the scan; no vector is shuffled."""
    rows = _chunks(spark, folder, "chunk_source", "model", page_ops.stale_chunk().alias("m"), page_ops.stale_chunk("embed-large-v3").alias("s"))
    return rows.groupBy("chunk_source", "model").agg(F.count("*").alias("chunks"), F.count_if("m").alias("missing"), F.count_if("s").alias("stale"))


@query(f"""SELECT source_id, count(*) AS pages FROM {_P} WHERE deleted_at IS NULL AND (links_extracted_at IS NULL OR updated_at > links_extracted_at
OR links_extracted_at < TIMESTAMP '2024-06-01') GROUP BY 1""")
def extraction_backlog(spark: SparkSession, folder: str) -> DataFrame:
    rows = _pages(spark, folder, "source_id", "deleted_at", "links_extracted_at", "updated_at").where("deleted_at IS NULL")
    return rows.where(page_ops.stale_extraction("2024-06-01")).groupBy("source_id").agg(F.count("*").alias("pages"))


@query(f"SELECT page_id, id AS chunk_id, chunk_index FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY chunk_index, id) AS n FROM {_C}) WHERE n = 1")
def first_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """The first chunk of each page: an aggregate rather than a window, so a huge page is combined before the shuffle."""
    rows = _chunks(spark, folder, "page_id", "chunk_index")
    return rows.groupBy("page_id").agg(F.min(F.struct("chunk_index", "id")).alias("f")).select("page_id", F.col("f.id").alias("chunk_id"), F.col("f.chunk_index").alias("chunk_index"))


# --- projections and text ---------------------------------------------------------------------------


@query(f"""SELECT id, trim(regexp_replace(translate(lower(title), '{text.ACCENTS[0]}', '{text.ACCENTS[1]}'), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM {_P} WHERE title IS NOT NULL""")
def title_slugs(spark: SparkSession, folder: str) -> DataFrame:
    return _pages(spark, folder, "title").where("title IS NOT NULL").select("id", text.slugify(F.col("title")).alias("slug"))


@query(f"""SELECT id, CAST(ceil(length(chunk_text) / 4) AS BIGINT) AS estimate, token_count, token_count IS NULL OR abs(token_count - length(chunk_text) / 4) > 0.5 * length(chunk_text) / 4 AS off
FROM {_C} WHERE chunk_text IS NOT NULL""")
def token_estimates(spark: SparkSession, folder: str) -> DataFrame:
    length = F.length("chunk_text") / 4
    off = F.col("token_count").isNull() | (F.abs(F.col("token_count") - length) > 0.5 * length)
    rows = _chunks(spark, folder, "chunk_text", "token_count").where("chunk_text IS NOT NULL")
    return rows.select("id", text.estimated_tokens(F.col("chunk_text")).alias("estimate"), "token_count", off.alias("off"))


@query("""SELECT doc_id, CAST(CASE WHEN s > 0 AND c >= 0.3 * s THEN s ELSE w END AS BIGINT) AS words FROM (SELECT doc_id,
length(regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]', '', 'g')) AS s,
length(regexp_replace(regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]', '', 'g'), '[^\\x{3040}-\\x{30ff}\\x{3400}-\\x{4dbf}\\x{4e00}-\\x{9fff}\\x{ac00}-\\x{d7af}]', '', 'g')) AS c,
len(list_filter(regexp_split_to_array(text, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')) AS w FROM documents WHERE text IS NOT NULL)""")
def document_words(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").where("text IS NOT NULL").select("doc_id", text.word_count(F.col("text")).alias("words"))


@query(f"""SELECT id, CASE WHEN effective_date IS NOT NULL THEN 'effective' WHEN updated_at IS NOT NULL THEN 'updated' ELSE 'created' END AS origin,
CAST(coalesce(effective_date, updated_at, created_at) AS DATE) AS day FROM {_P}""")
def effective_days(spark: SparkSession, folder: str) -> DataFrame:
    """The date a page counts under, by precedence."""
    rows = _pages(spark, folder, "effective_date", "updated_at", "created_at")
    origin = F.when(F.col("effective_date").isNotNull(), "effective").when(F.col("updated_at").isNotNull(), "updated").otherwise("created")
    return rows.select("id", origin.alias("origin"), F.coalesce("effective_date", "updated_at", "created_at").cast("date").alias("day"))


@query(f"""SELECT tag, count(*) AS pages, count(DISTINCT type) AS types FROM (SELECT DISTINCT id, type, unnest(from_json(json_extract(frontmatter, '$.tags'), '["VARCHAR"]')) AS tag FROM {_P}) GROUP BY 1""")
def tags(spark: SparkSession, folder: str) -> DataFrame:
    rows = _pages(spark, folder, "type", "frontmatter").select("id", "type", F.explode(F.from_json(F.get_json_object("frontmatter", "$.tags"), "array<string>")).alias("tag")).distinct()
    return rows.groupBy("tag").agg(F.count("*").alias("pages"), F.countDistinct("type").alias("types"))


@query(f"""SELECT DISTINCT id, lower(trim(unnest(regexp_extract_all(regexp_replace(regexp_replace(compiled_truth, '(?s)```.*?(```|$)', '', 'g'), '`[^`\\n]*`', '', 'g'), '\\[\\[([^\\]|\\n]+)(?:\\|[^\\]\\n]*)?\\]\\]', 1)))) AS target FROM {_P}""")
def wiki_links(spark: SparkSession, folder: str) -> DataFrame:
    """Edge extraction: links in double brackets, outside code."""
    rows = table(spark, folder, "pages").where("compiled_truth LIKE '%[[%'")
    return rows.select("id", F.explode(text.wiki_targets(F.col("compiled_truth"))).alias("target")).distinct()


@query(f"""WITH t AS (SELECT DISTINCT id, lower(trim(unnest(regexp_extract_all(regexp_replace(regexp_replace(compiled_truth, '(?s)```.*?(```|$)', '', 'g'), '`[^`\\n]*`', '', 'g'), '\\[\\[([^\\]|\\n]+)(?:\\|[^\\]\\n]*)?\\]\\]', 1)))) AS target FROM {_P}),
s AS (SELECT slug, count(DISTINCT id) AS n FROM pages GROUP BY 1)
SELECT target, count(*) AS mentions, CAST(coalesce(max(s.n), 0) AS BIGINT) AS pages FROM t LEFT JOIN s ON s.slug = t.target GROUP BY 1""")
def link_resolution(spark: SparkSession, folder: str) -> DataFrame:
    """How many pages each linked slug resolves to; 0 for dangling links. Mentions are counted before the join."""
    wanted = wiki_links(spark, folder).groupBy("target").agg(F.count("*").alias("mentions"))
    known = _pages(spark, folder, "slug").groupBy(F.col("slug").alias("target")).agg(F.count("*").alias("pages"))
    return wanted.join(known, "target", "left").select("target", "mentions", F.coalesce("pages", F.lit(0).cast("bigint")).alias("pages"))


# --- graph ------------------------------------------------------------------------------------------

_E = "(SELECT DISTINCT from_page_id AS src, to_page_id AS dst, link_type, link_source FROM links)"


@query(f"SELECT coalesce(link_source, 'none') AS source, link_type, count(*) AS links FROM {_E} GROUP BY ALL")
def link_provenance(spark: SparkSession, folder: str) -> DataFrame:
    rows = graph.edges(table(spark, folder, "links"))
    return rows.groupBy(F.coalesce("link_source", F.lit("none")).alias("source"), "link_type").agg(F.count("*").alias("links"))


@query(f"SELECT p.id, count(e.src) AS backlinks FROM (SELECT DISTINCT id FROM pages) p LEFT JOIN (SELECT * FROM {_E} WHERE link_type IS DISTINCT FROM 'mentions') e ON e.dst = p.id GROUP BY 1")
def backlinks(spark: SparkSession, folder: str) -> DataFrame:
    return graph.in_degree(table(spark, folder, "pages"), table(spark, folder, "links"))


@query(f"""WITH live AS (SELECT DISTINCT id FROM pages WHERE deleted_at IS NULL)
SELECT id FROM live WHERE NOT EXISTS (SELECT 1 FROM {_E} e JOIN live f ON f.id = e.src WHERE e.dst = live.id AND e.src <> e.dst)""")
def orphan_pages(spark: SparkSession, folder: str) -> DataFrame:
    return graph.orphans(table(spark, folder, "pages"), table(spark, folder, "links"))


@query(f"""WITH e AS (SELECT DISTINCT src, dst FROM {_E} WHERE link_type = 'mentions')
SELECT src, dst FROM e WHERE NOT EXISTS (SELECT 1 FROM e r WHERE r.src = e.dst AND r.dst = e.src)""")
def missing_reciprocals(spark: SparkSession, folder: str) -> DataFrame:
    return graph.unreciprocated(table(spark, folder, "links"), "mentions").select("src", "dst")


@query(f"""WITH RECURSIVE seeds AS (SELECT DISTINCT id FROM pages WHERE type = 'project'),
walk AS (SELECT id, 0 AS hop FROM seeds UNION SELECT e.dst, w.hop + 1 FROM walk w JOIN {_E} e ON e.src = w.id AND e.src <> e.dst WHERE w.hop < 3)
SELECT id, min(hop) AS hop FROM walk GROUP BY 1""")
def project_fan_out(spark: SparkSession, folder: str) -> DataFrame:
    """All pages within three links of a project page, with their distance."""
    seeds = table(spark, folder, "pages").where("type = 'project'").select("id")
    return graph.fan_out(seeds, table(spark, folder, "links"), 3)


@query(f"""SELECT dst AS id, count(*) AS seeds FROM (SELECT DISTINCT src, dst FROM {_E}) e WHERE src IN (SELECT id FROM pages WHERE type = 'meeting') GROUP BY 1 HAVING count(*) > 1""")
def common_topics(spark: SparkSession, folder: str) -> DataFrame:
    return graph.common_targets(table(spark, folder, "pages").where("type = 'meeting'"), table(spark, folder, "links"))


@query(f"""WITH m AS (SELECT DISTINCT id, source_id FROM pages WHERE type IN ('person', 'company')), e AS (SELECT DISTINCT src, dst FROM {_E} WHERE src <> dst)
SELECT e.dst AS id, count(*) AS inside, count(DISTINCT CASE WHEN a.source_id <> b.source_id THEN a.source_id END) AS sources
FROM e JOIN m a ON a.id = e.src JOIN m b ON b.id = e.dst GROUP BY 1""")
def people_graph(spark: SparkSession, folder: str) -> DataFrame:
    return graph.induced_degree(table(spark, folder, "pages").where("type IN ('person', 'company')"), table(spark, folder, "links"))


@query(f"""SELECT p.id, p.type, coalesce(i.n, 0) + coalesce(o.n, 0) AS connections FROM (SELECT DISTINCT id, type FROM pages WHERE deleted_at IS NULL) p
LEFT JOIN (SELECT dst AS id, count(*) AS n FROM {_E} GROUP BY 1) i USING (id) LEFT JOIN (SELECT src AS id, count(*) AS n FROM {_E} GROUP BY 1) o USING (id)
WHERE p.type IN ('person', 'company', 'project') ORDER BY connections DESC, p.id LIMIT 5""")
def most_connected(spark: SparkSession, folder: str) -> DataFrame:
    found = graph.edges(table(spark, folder, "links"))
    ends = found.select(F.explode(F.array("src", "dst")).alias("id"))
    degree = ends.groupBy("id").agg(F.count("*").alias("connections"))
    live = _pages(spark, folder, "type", "deleted_at").where("deleted_at IS NULL AND type IN ('person', 'company', 'project')")
    return live.join(degree, "id", "left").select("id", "type", F.coalesce("connections", F.lit(0).cast("bigint")).alias("connections")).orderBy(F.desc("connections"), "id").limit(5)


# --- aggregates -------------------------------------------------------------------------------------


@query(f"""SELECT (SELECT count(DISTINCT id) FROM pages WHERE deleted_at IS NULL) AS pages, (SELECT count(DISTINCT id) FROM content_chunks) AS chunks,
(SELECT count(DISTINCT id) FROM content_chunks WHERE embedding IS NOT NULL) AS embedded, (SELECT count(*) FROM {_E}) AS links,
(SELECT count(*) FROM (SELECT DISTINCT page_id, date, source, summary FROM timeline_entries)) AS entries""")
def corpus_stats(spark: SparkSession, folder: str) -> DataFrame:
    """One row of corpus counts: independent one-row aggregates side by side."""
    one = lambda df, name: df.agg(F.count("*").alias(name))
    chunks = table(spark, folder, "content_chunks").groupBy("id").agg(F.max(F.col("embedding").isNotNull()).alias("e"))
    parts = [
        one(table(spark, folder, "pages").where("deleted_at IS NULL").select("id").distinct(), "pages"),
        chunks.agg(F.count("*").alias("chunks"), F.count_if("e").alias("embedded")), one(graph.edges(table(spark, folder, "links")), "links"),
        one(table(spark, folder, "timeline_entries").select("page_id", "date", "source", "summary").distinct(), "entries"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.crossJoin(part)  # one row each
    return out.select("pages", "chunks", "embedded", "links", "entries")


@query(f"""SELECT coalesce(source_id, '(all)') AS source, coalesce(type, '(all)') AS type, count(*) AS pages, round(avg(length(compiled_truth)), 4) AS mean_chars
FROM {_P} GROUP BY ROLLUP (source_id, type)""")
def type_coverage(spark: SparkSession, folder: str) -> DataFrame:
    rows = _pages(spark, folder, "source_id", "type", F.length("compiled_truth").alias("n"))
    out = rows.rollup("source_id", "type").agg(F.count("*").alias("pages"), F.round(F.avg("n"), 4).alias("mean_chars"))
    return out.select(F.coalesce("source_id", F.lit("(all)")).alias("source"), F.coalesce("type", F.lit("(all)")).alias("type"), "pages", "mean_chars")


@query(f"""SELECT p.source_id, count(DISTINCT p.id) AS pages, count(c.id) AS chunks, count(c.id) FILTER (c.embedding IS NOT NULL) AS embedded
FROM (SELECT DISTINCT id, source_id FROM pages) p LEFT JOIN {_C} c ON c.page_id = p.id GROUP BY 1""")
def source_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks are counted per page before the join, so a page with very many chunks is one row in it."""
    rows = _chunks(spark, folder, "page_id", F.col("embedding").isNotNull().alias("e"))
    per_page = rows.groupBy(F.col("page_id").alias("id")).agg(F.count("*").alias("c"), F.count_if("e").alias("e"))
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return _pages(spark, folder, "source_id").join(per_page, "id", "left").groupBy("source_id").agg(F.count("*").alias("pages"), zero("c").alias("chunks"), zero("e").alias("embedded"))


@query(f"""SELECT split_part(slug, '/', 1) AS prefix, count(*) AS pages, count(DISTINCT type) AS types, min(id) AS sample FROM {_P} GROUP BY 1 HAVING count(*) >= 3""")
def prefix_histogram(spark: SparkSession, folder: str) -> DataFrame:
    rows = _pages(spark, folder, "slug", "type")
    return rows.groupBy(F.split_part("slug", F.lit("/"), F.lit(1)).alias("prefix")).agg(F.count("*").alias("pages"), F.countDistinct("type").alias("types"), F.min("id").alias("sample")).where("pages >= 3")


@query(f"""SELECT id, round(coalesce(CAST(emotional_weight AS DOUBLE), 0) * 5 + ln(1 + coalesce(n, 0)), 6) AS salience,
round(30.0 / (30.0 + greatest((epoch_us(TIMESTAMP '{NOW}') - epoch_us(coalesce(updated_at, created_at))) / 86400000000.0, 0)), 6) AS recency
FROM {_P} p LEFT JOIN (SELECT page_id, count(DISTINCT (date, summary)) AS n FROM timeline_entries GROUP BY 1) t ON t.page_id = p.id""")
def page_salience(spark: SparkSession, folder: str) -> DataFrame:
    entries = table(spark, folder, "timeline_entries").select("page_id", "date", "summary").distinct().groupBy(F.col("page_id").alias("id")).agg(F.count("*").alias("n"))
    rows = _pages(spark, folder, "emotional_weight", "updated_at", "created_at").join(entries, "id", "left")
    salience = F.coalesce(F.col("emotional_weight").cast("double"), F.lit(0.0)) * 5 + F.log(1 + F.coalesce("n", F.lit(0)))
    recency = scores.hyperbolic(scores.age_days(F.coalesce("updated_at", "created_at"), NOW), 30.0)
    return rows.select("id", F.round(salience, 6).alias("salience"), F.round(recency, 6).alias("recency"))


_J = "(SELECT DISTINCT * FROM minion_jobs)"
_LATEST = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC NULLS LAST, status DESC) AS n FROM {_J}) WHERE n = 1)"


def _jobs(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """The latest snapshot of each job, by an aggregate that combines before the shuffle."""
    wanted = list(dict.fromkeys(["status", "updated_at", *columns]))
    best = F.max_by(F.struct(*wanted), F.struct("updated_at", "status")).alias("j")
    return table(spark, folder, "minion_jobs").groupBy("id").agg(best).select("id", "j.*")


@query(f"SELECT id, status, attempts_made FROM {_LATEST}")
def current_jobs(spark: SparkSession, folder: str) -> DataFrame:
    return _jobs(spark, folder, "attempts_made").select("id", "status", "attempts_made")


@query(f"""SELECT name, status, count(*) AS jobs, round(avg((epoch_us(finished_at) - epoch_us(started_at)) / 1e6) FILTER (finished_at >= started_at), 4) AS mean_s, CAST(coalesce(sum(tokens_input), 0) AS BIGINT) AS tokens
FROM {_LATEST} GROUP BY ALL""")
def job_stats(spark: SparkSession, folder: str) -> DataFrame:
    rows = _jobs(spark, folder, "name", "started_at", "finished_at", "tokens_input")
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    took = F.when(F.col("finished_at") >= F.col("started_at"), (micros("finished_at") - micros("started_at")) / 1e6)
    return rows.groupBy("name", "status").agg(F.count("*").alias("jobs"), F.round(F.avg(took), 4).alias("mean_s"), F.coalesce(F.sum("tokens_input"), F.lit(0)).cast("bigint").alias("tokens"))


@query(f"""SELECT name, round(quantile_cont(s, 0.5), 3) AS median_s, round(quantile_cont(s, 0.95), 3) AS p95_s FROM (SELECT name, (epoch_us(finished_at) - epoch_us(started_at)) / 1e6 AS s FROM {_LATEST} WHERE finished_at >= started_at) GROUP BY 1""")
def job_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    rows = _jobs(spark, folder, "name", "started_at", "finished_at").where("finished_at >= started_at")
    took = (F.unix_micros(F.col("finished_at").cast("timestamp")) - F.unix_micros(F.col("started_at").cast("timestamp"))) / 1e6
    return rows.groupBy("name").agg(F.round(F.percentile(took, 0.5), 3).alias("median_s"), F.round(F.percentile(took, 0.95), 3).alias("p95_s"))


@query(f"""SELECT id, priority FROM {_LATEST} WHERE status = 'waiting' ORDER BY priority, created_at, id LIMIT 20""")
def next_jobs(spark: SparkSession, folder: str) -> DataFrame:
    """The queue's head: the order in which workers take waiting jobs."""
    return _jobs(spark, folder, "priority", "created_at").where("status = 'waiting'").orderBy(F.asc_nulls_last("priority"), F.asc_nulls_last("created_at"), "id").limit(20).select("id", "priority")


@query(f"""SELECT id, CASE WHEN attempts_made < max_attempts THEN 'retry' ELSE 'dead' END AS verdict FROM {_LATEST} WHERE status = 'active' AND lock_until < TIMESTAMP '{NOW}'""")
def expired_locks(spark: SparkSession, folder: str) -> DataFrame:
    rows = _jobs(spark, folder, "lock_until", "attempts_made", "max_attempts").where(f"status = 'active' AND lock_until < TIMESTAMP_NTZ '{NOW}'")
    return rows.select("id", F.when(F.col("attempts_made") < F.col("max_attempts"), "retry").otherwise("dead").alias("verdict"))


# --- timelines --------------------------------------------------------------------------------------

_T = "(SELECT DISTINCT page_id, date, source, summary FROM timeline_entries)"


@query(f"SELECT page_id, date AS day, summary FROM {_T} WHERE date >= DATE '2025-01-01' AND date < DATE '2025-04-01'")
def timeline_window(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "timeline_entries").where("date >= DATE '2025-01-01' AND date < DATE '2025-04-01'")
    return rows.select("page_id", "date", "source", "summary").distinct().select("page_id", F.col("date").alias("day"), "summary")


@query(f"""SELECT page_id, first_day, last_day, entries, round(entries * 30.0 / (1 + date_diff('day', first_day, last_day)), 6) AS monthly FROM
(SELECT page_id, min(date) AS first_day, max(date) AS last_day, count(*) AS entries FROM {_T} GROUP BY 1)""")
def timeline_pace(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "timeline_entries").select("page_id", "date", "source", "summary").distinct()
    out = rows.groupBy("page_id").agg(F.min("date").alias("first_day"), F.max("date").alias("last_day"), F.count("*").alias("entries"))
    return out.withColumn("monthly", F.round(F.col("entries") * 30.0 / (1 + F.date_diff("last_day", "first_day")), 6))


@query(f"""SELECT page_id, day, lead(day) OVER (PARTITION BY page_id ORDER BY day) AS valid_until, n FROM (SELECT page_id, date AS day, count(*) AS n FROM {_T} GROUP BY ALL)""")
def validity(spark: SparkSession, folder: str) -> DataFrame:
    """Each dated state of a page holds until the next one begins. Entries of a day are counted before the window."""
    rows = table(spark, folder, "timeline_entries").select("page_id", F.col("date").alias("day"), "source", "summary").distinct().groupBy("page_id", "day").agg(F.count("*").alias("n"))
    return rows.withColumn("valid_until", F.lead("day").over(Window.partitionBy("page_id").orderBy("day"))).select("page_id", "day", "valid_until", "n")


@query(f"""SELECT p.id, count(t.page_id) AS near FROM (SELECT DISTINCT id, CAST(effective_date AS DATE) AS d FROM pages WHERE effective_date IS NOT NULL) p
LEFT JOIN {_T} t ON t.page_id = p.id AND t.date BETWEEN p.d - 30 AND p.d + 30 GROUP BY 1""")
def entries_near_date(spark: SparkSession, folder: str) -> DataFrame:
    """Interval join on top of an equi-join: entries within 30 days of the page's own date."""
    entries = table(spark, folder, "timeline_entries").select(F.col("page_id").alias("id"), "date", "source", "summary").distinct()
    rows = _pages(spark, folder, F.col("effective_date").cast("date").alias("d")).where("d IS NOT NULL").join(entries, "id", "left")
    near = F.abs(F.date_diff("date", "d")) <= 30
    return rows.groupBy("id").agg(F.count_if(near).alias("near"))


# --- search -----------------------------------------------------------------------------------------


def _live(spark: SparkSession, folder: str) -> DataFrame:
    return page_ops.visible(_pages(spark, folder, "source_id", "slug", "type", "title", "deleted_at", "frontmatter"), table(spark, folder, "sources"))


_LIVE = """(SELECT DISTINCT p.id, p.slug, p.type, p.title, p.source_id FROM pages p JOIN sources s ON s.id = p.source_id WHERE p.deleted_at IS NULL AND NOT coalesce(s.archived, false)
AND coalesce(json_extract_string(p.frontmatter, '$.quarantined'), 'false') <> 'true')"""
_KEYWORD = r"""(SELECT c.id, c.page_id, (log2(1 + len(regexp_extract_all(lower(chunk_text), '(?:^|[^a-z0-9])budget(?:$|[^a-z0-9])'))) + log2(1 + len(regexp_extract_all(lower(chunk_text), '(?:^|[^a-z0-9])pilot(?:$|[^a-z0-9])')))) / log2(2 + length(chunk_text)) AS score
FROM (SELECT DISTINCT id, page_id, chunk_text FROM content_chunks) c WHERE regexp_matches(lower(chunk_text), '(^|[^a-z0-9])budget($|[^a-z0-9])') AND regexp_matches(lower(chunk_text), '(^|[^a-z0-9])pilot($|[^a-z0-9])'))"""


@query(f"""SELECT page_id, chunk_id, round(score, 6) AS score FROM (SELECT k.page_id, k.id AS chunk_id, k.score, row_number() OVER (PARTITION BY k.page_id ORDER BY k.score DESC, k.id) AS n
FROM {_KEYWORD} k JOIN {_LIVE} p ON p.id = k.page_id) WHERE n = 1""")
def keyword_search(spark: SparkSession, folder: str) -> DataFrame:
    """Pages by their best chunk for two words."""
    hits = search.keyword_hits(_chunks(spark, folder, "page_id", "chunk_text"), ["budget", "pilot"])
    live = _live(spark, folder).select(F.col("id").alias("page_id"))
    best = search.best_per(hits.join(live, "page_id", "left_semi"), ["page_id"])
    return best.select("page_id", F.col("id").alias("chunk_id"), F.round("score", 6).alias("score"))


@query("""SELECT doc_id, round((length(lower(text)) - length(replace(lower(text), '预算', ''))) / 2.0 + 1.0 / instr(lower(text), '预算'), 6) AS score FROM documents WHERE instr(lower(text), '预算') > 0""")
def substring_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.substring_hits(table(spark, folder, "documents"), "预算", "text").select("doc_id", F.round("score", 6).alias("score"))


@query("""WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE len(embedding) = 64)
SELECT vec_id, neighbour, round(score, 5) AS score, rank FROM (SELECT q.vec_id, v.vec_id AS neighbour, list_cosine_similarity(q.e, v.e) AS score,
row_number() OVER (PARTITION BY q.vec_id ORDER BY list_cosine_similarity(q.e, v.e) DESC, v.vec_id) AS rank FROM v q, v WHERE q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id) WHERE rank <= 10""")
def nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The ten vectors most similar to each of those with an id divisible by 50, among all."""
    found = vectors.nearest_of(table(spark, folder, "embeddings"), F.col("id") % 50 == 0, "vec_id", k=10)
    return found.select(F.col("id").alias("vec_id"), "neighbour", F.round("similarity", 5).alias("score"), "rank")


@query(f"""WITH k AS (SELECT page_id AS id, max(score) AS score FROM {_KEYWORD} GROUP BY 1), a AS (SELECT k.id, row_number() OVER (ORDER BY k.score DESC, k.id) - 1 AS r FROM k JOIN {_LIVE} p USING (id) QUALIFY r < 60),
d AS (SELECT p.id, count(e.src) AS n FROM {_LIVE} p LEFT JOIN (SELECT * FROM {_E} WHERE link_type IS DISTINCT FROM 'mentions') e ON e.dst = p.id GROUP BY 1), b AS (SELECT id, row_number() OVER (ORDER BY n DESC, id) - 1 AS r FROM d WHERE n > 0 QUALIFY r < 60),
f AS (SELECT id, sum(w / (60 + r)) AS s FROM (SELECT id, r, 1.0 AS w FROM a UNION ALL SELECT id, r, 0.5 FROM b) GROUP BY 1)
SELECT id, round(s / (SELECT max(s) FROM f), 6) AS score FROM f""")
def hybrid_search(spark: SparkSession, folder: str) -> DataFrame:
    """Keyword and graph arms fused by reciprocal rank."""
    live = _live(spark, folder).select("id").distinct()
    hits = search.keyword_hits(_chunks(spark, folder, "page_id", "chunk_text"), ["budget", "pilot"]).groupBy(F.col("page_id").alias("id")).agg(F.max("score").alias("score"))
    keyword = search.ranked(hits.join(live, "id", "left_semi"), 60, "id")
    degree = graph.in_degree(live, table(spark, folder, "links")).where("backlinks > 0").withColumnRenamed("backlinks", "score")
    fused = search.fused([keyword, search.ranked(degree, 60, "id")], "id", weights=[1.0, 0.5])
    return fused.select("id", F.round("score", 6).alias("score"))


@query(f"""WITH r AS (SELECT id, type, round(ln(1 + n), 6) AS score FROM (SELECT p.id, p.type, count(e.src) AS n FROM {_LIVE} p JOIN {_E} e ON e.dst = p.id GROUP BY ALL) ORDER BY score DESC, id LIMIT 40)
SELECT id, type, score FROM (SELECT *, row_number() OVER (PARTITION BY type ORDER BY score DESC, id) AS n FROM r) WHERE n <= ceil((SELECT count(*) FROM r) * 0.3)""")
def diverse_ranking(spark: SparkSession, folder: str) -> DataFrame:
    """A ranking of 40 in which no page type takes more than 30 %."""
    count = graph.edges(table(spark, folder, "links")).groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("n"))
    rows = _live(spark, folder).select("id", "type").distinct().join(count, "id").withColumn("score", F.round(F.log(1 + F.col("n").cast("double")), 6))
    return search.capped_share(rows.select("id", "type", "score"), "type", 0.3, 40, "id")


@query(f"""SELECT page_id, id AS chunk_id, spent FROM (SELECT page_id, id, sum(cost) OVER (PARTITION BY page_id ORDER BY chunk_index, id) AS spent FROM (SELECT id, page_id, chunk_index, CAST(ceil(length(coalesce(chunk_text, '')) / 4) AS BIGINT) AS cost
FROM (SELECT DISTINCT id, page_id, chunk_index, chunk_text FROM content_chunks WHERE chunk_source = 'compiled_truth'))) WHERE spent <= 1000""")
def context_budget(spark: SparkSession, folder: str) -> DataFrame:
    """The beginning of each page's body chunks that fits into a budget of 1,000 tokens."""
    cost = text.estimated_tokens(F.coalesce("chunk_text", F.lit("")))
    rows = table(spark, folder, "content_chunks").where("chunk_source = 'compiled_truth'").select("id", "page_id", "chunk_index", cost.alias("cost")).distinct()
    return search.within_budget(rows, "cost", 1000, [F.asc("chunk_index"), F.asc("id")], ["page_id"], F.col("chunk_index")).select("page_id", F.col("id").alias("chunk_id"), "spent")


@query(f"""WITH t AS (SELECT DISTINCT id, title, list_distinct(flatten(list_transform(list_filter(string_split(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> ''),
lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3))))) AS g FROM pages WHERE title IS NOT NULL),
q AS (SELECT list_distinct(flatten(list_transform(['budget', 'review'], lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3))))) AS g)
SELECT id, round(len(list_intersect(t.g, q.g)) / len(list_distinct(list_concat(t.g, q.g))), 6) AS score FROM t, q WHERE len(list_intersect(t.g, q.g)) / len(list_distinct(list_concat(t.g, q.g))) >= 0.2""")
def fuzzy_titles(spark: SparkSession, folder: str) -> DataFrame:
    """Titles whose trigrams resemble a phrase."""
    rows = _pages(spark, folder, "title").where("title IS NOT NULL").withColumn("s", text.similarity(F.col("title"), F.lit("budget review")))
    return rows.where("s >= 0.2").select("id", F.round("s", 6).alias("score"))


@query(f"""WITH judged AS (SELECT DISTINCT from_page_id AS query, to_page_id AS doc FROM links), hits AS (SELECT query, doc, row_number() OVER (PARTITION BY query ORDER BY n DESC, doc) AS rank FROM
(SELECT e.query, e.doc, d.n FROM (SELECT DISTINCT from_page_id AS query, to_page_id AS doc FROM links WHERE link_type = 'mentions') e JOIN (SELECT dst AS doc, count(*) AS n FROM {_E} GROUP BY 1) d USING (doc)) QUALIFY rank <= 5),
met AS (SELECT h.query, count(*) AS found, min(rank) AS first, sum(1 / log2(rank + 1)) AS gain FROM hits h JOIN judged USING (query, doc) GROUP BY 1), size AS (SELECT query, count(*) AS relevant FROM judged GROUP BY 1)
SELECT query, round(coalesce(found / 5, 0), 6) AS precision, round(coalesce(found / relevant, 0), 6) AS recall, round(coalesce(1 / first, 0), 6) AS reciprocal_rank,
round(coalesce(gain / list_sum(list_transform(range(1, least(relevant, 5) + 1), lambda i: 1 / log2(i + 1))), 0), 6) AS ndcg FROM size LEFT JOIN met USING (query)""")
def retrieval_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Precision, recall, reciprocal rank and nDCG at 5 of a ranking by link popularity, against all links as judgements."""
    found = graph.edges(table(spark, folder, "links"))
    popular = found.groupBy(F.col("dst").alias("doc")).agg(F.count("*").alias("score"))
    asked = found.where("link_type = 'mentions'").select(F.col("src").alias("query"), F.col("dst").alias("doc")).distinct().join(popular, "doc")
    place = Window.partitionBy("query").orderBy(F.desc("score"), "doc")
    hits = asked.withColumn("rank", F.row_number().over(place)).where("rank <= 5")
    out = search.quality(hits, found.select(F.col("src").alias("query"), F.col("dst").alias("doc")), 5)
    return out.select("query", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "reciprocal_rank", "ndcg")])
