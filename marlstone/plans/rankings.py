"""Queries over boosts, decays, code edges and calendars, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scores
from ..operators import graph, ranking, search
from ..sources.tables import table
from .knowledge import _E, _KEYWORD, _LIVE, _P, NOW, _chunks, _live, _pages
from .registry import query


@query(f"""WITH k AS (SELECT page_id AS id, max(score) AS score FROM {_KEYWORD} GROUP BY 1), b AS (SELECT dst AS id, count(*) AS n FROM {_E} WHERE link_type IS DISTINCT FROM 'mentions' GROUP BY 1),
t AS (SELECT DISTINCT id, updated_at FROM pages)
SELECT k.id, round(k.score * (1 + 0.05 * ln(1 + coalesce(b.n, 0))) * (1 + 0.3 * 30 / (30 + greatest((epoch_us(TIMESTAMP '{NOW}') - epoch_us(t.updated_at)) / 86400000000.0, 0))) * CASE WHEN contains(lower(p.title), 'budget') THEN 1.25 ELSE 1 END
* CASE WHEN regexp_matches(p.slug, 'pilot') THEN 1.05 ELSE 1 END, 6) AS score FROM k JOIN {_LIVE} p USING (id) JOIN t USING (id) LEFT JOIN b USING (id) WHERE t.updated_at IS NOT NULL""")
def boosted_search(spark: SparkSession, folder: str) -> DataFrame:
    """Keyword hits with backlink, recency, title and alias boosts."""
    hits = search.keyword_hits(_chunks(spark, folder, "page_id", "chunk_text"), ["budget", "pilot"]).groupBy(F.col("page_id").alias("id")).agg(F.max("score").alias("score"))
    live = _live(spark, folder).select("id", "title", "slug").distinct()
    links = graph.edges(table(spark, folder, "links")).where(~F.col("link_type").eqNullSafe("mentions")).groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("n"))
    rows = hits.join(live, "id").join(_pages(spark, folder, "updated_at").where("updated_at IS NOT NULL"), "id").join(links, "id", "left")
    score = ranking.boosted(F.col("score"), F.coalesce("n", F.lit(0)), scores.age_days(F.col("updated_at"), NOW), F.coalesce(F.lower("title").contains("budget"), F.lit(False)), F.col("slug").contains("pilot"))
    return rows.select("id", F.round(score, 6).alias("score"))


@query(r"""SELECT intent, count(*) AS pages FROM (SELECT DISTINCT id, CASE WHEN regexp_matches(lower(title), '\b(when|since|until|latest|recent|yesterday|today|last (week|month|year)|timeline|history)\b') THEN 'temporal'
WHEN regexp_matches(lower(title), '\b(meeting|call|offsite|launch|retro|review|workshop|demo)\b') THEN 'event' WHEN regexp_matches(lower(title), '\b(who|company|person|team|founder|customer|vendor|landlord)\b') THEN 'entity' ELSE 'general' END AS intent FROM pages) GROUP BY 1""")
def title_intents(spark: SparkSession, folder: str) -> DataFrame:
    return _pages(spark, folder, "title").groupBy(ranking.intent(F.col("title")).alias("intent")).agg(F.count("*").alias("pages"))


@query(f"""SELECT page_id, day, round(least(1.0, greatest(0.0, 0.9 * exp(-greatest(date_diff('day', day, DATE '2026-01-01'), 0) / CASE type WHEN 'meeting' THEN 30.0 WHEN 'note' THEN 90.0 WHEN 'email' THEN 14.0 WHEN 'project' THEN 180.0 WHEN 'person' THEN 365.0 WHEN 'company' THEN 365.0 ELSE 60.0 END))), 6) AS confidence
FROM (SELECT page_id, max(date) AS day FROM timeline_entries GROUP BY 1) t JOIN (SELECT DISTINCT id, type FROM pages) p ON p.id = t.page_id""")
def fact_confidence(spark: SparkSession, folder: str) -> DataFrame:
    """The newest entry of each page, fading by the page's type."""
    newest = table(spark, folder, "timeline_entries").groupBy(F.col("page_id").alias("id")).agg(F.max("date").alias("day"))
    age = F.date_diff(F.lit("2026-01-01").cast("date"), "day").cast("double")
    rows = newest.join(_pages(spark, folder, "type"), "id")
    return rows.select(F.col("id").alias("page_id"), "day", F.round(ranking.confidence(F.lit(0.9), age, F.col("type")), 6).alias("confidence"))


@query(r"""SELECT doc_id, CAST(greatest(0, ceil((n - 300) / 250)) AS INT) + 1 AS parts, n - 250 * CAST(greatest(0, ceil((n - 300) / 250)) AS INT) AS last_words FROM
(SELECT doc_id, len(list_filter(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+'), lambda w: w <> '')) AS n FROM documents WHERE text IS NOT NULL) WHERE n > 0""")
def word_windows(spark: SparkSession, folder: str) -> DataFrame:
    rows = ranking.word_windows(table(spark, folder, "documents"), "doc_id", "text")
    last = F.max_by(F.size("words"), "part").cast("bigint")
    return rows.groupBy("doc_id").agg(F.count("*").cast("int").alias("parts"), last.alias("last_words"))


@query(r"""SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}', '[email]', 'g'), '\beyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+', '[token]', 'g'),
'(?i)\bbearer [A-Za-z0-9._-]{8,}', '[token]', 'g'), '\b\d{3}-\d{2}-\d{4}\b', '[ssn]', 'g'), '\b\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}\b', '[card]', 'g')) AS digest FROM documents WHERE text IS NOT NULL""")
def redacted_digests(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").where("text IS NOT NULL")
    return rows.select("doc_id", F.md5(ranking.redacted(F.col("text"))).alias("digest"))


_CALLS = r"(SELECT DISTINCT id AS chunk_id, unnest(regexp_extract_all(chunk_text, '\b([A-Za-z_][A-Za-z0-9_]*)\(', 1)) AS callee FROM content_chunks WHERE language IS NOT NULL)"


@query(f"""WITH s AS (SELECT symbol_name AS callee, min(id) AS target FROM content_chunks WHERE symbol_name IS NOT NULL GROUP BY 1)
SELECT c.chunk_id, c.callee, s.target, s.target IS NOT NULL AS resolved FROM {_CALLS} c LEFT JOIN s USING (callee)""")
def call_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Calls in code chunks, resolved to the chunk that defines the symbol where one does."""
    code = table(spark, folder, "content_chunks").where("language IS NOT NULL")
    found = F.regexp_extract_all("chunk_text", F.lit(r"\b([A-Za-z_][A-Za-z0-9_]*)\("), 1)
    calls = code.select(F.col("id").alias("chunk_id"), F.explode(found).alias("callee")).distinct()
    known = table(spark, folder, "content_chunks").where("symbol_name IS NOT NULL").groupBy(F.col("symbol_name").alias("callee")).agg(F.min("id").alias("target"))
    return calls.join(known, "callee", "left").select("chunk_id", "callee", "target", F.col("target").isNotNull().alias("resolved"))


@query(f"""WITH s AS (SELECT symbol_name AS callee, min(id) AS target FROM content_chunks WHERE symbol_name IS NOT NULL GROUP BY 1), e AS (SELECT c.chunk_id, s.target FROM {_CALLS} c JOIN s USING (callee) WHERE c.chunk_id <> s.target)
SELECT target AS chunk_id, count(*) AS callers, round(1 / (1 + 0.3 * 1), 6) AS confidence FROM (SELECT DISTINCT * FROM e) GROUP BY 1""")
def callers(spark: SparkSession, folder: str) -> DataFrame:
    edges = call_edges(spark, folder).where("resolved AND chunk_id <> target").select("chunk_id", "target").distinct()
    return edges.groupBy(F.col("target").alias("chunk_id")).agg(F.count("*").alias("callers"), F.round(F.lit(1 / 1.3), 6).alias("confidence"))


@query(f"""WITH d AS (SELECT CAST(created_at AS DATE) AS day, count(*) AS n FROM {_P} WHERE created_at IS NOT NULL GROUP BY 1)
SELECT day, n, CAST(sum(n) OVER (ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) AS BIGINT) AS week FROM d""")
def import_trend(spark: SparkSession, folder: str) -> DataFrame:
    """Imports of each day and of the seven days up to it. Only one row a day reaches the single window."""
    days = _pages(spark, folder, F.col("created_at").cast("date").alias("day")).where("day IS NOT NULL").groupBy("day").agg(F.count("*").alias("n"))
    span = Window.orderBy(F.unix_date("day")).rangeBetween(-6, 0)
    return days.select("day", "n", F.sum("n").over(span).alias("week"))


@query("""WITH f AS (SELECT user_id, min(CAST(ts AS DATE)) AS first FROM events GROUP BY 1)
SELECT CAST(date_trunc('week', first) AS DATE) AS cohort, CAST(floor(date_diff('day', first, CAST(ts AS DATE)) / 7) AS INT) AS week, count(DISTINCT user_id) AS users FROM events JOIN f USING (user_id) GROUP BY ALL""")
def cohort_retention(spark: SparkSession, folder: str) -> DataFrame:
    """Users of each weekly cohort that are active so many weeks later."""
    days = table(spark, folder, "events").select("user_id", F.col("ts").cast("date").alias("day")).distinct()
    first = days.groupBy("user_id").agg(F.min("day").alias("first"))
    rows = days.join(first, "user_id")
    week = F.floor(F.date_diff("day", "first") / 7).cast("int")
    return rows.groupBy(F.trunc("first", "week").alias("cohort"), week.alias("week")).agg(F.countDistinct("user_id").alias("users"))


@query(f"""WITH t AS (SELECT tag, count(*) AS n FROM (SELECT DISTINCT id, unnest(from_json(json_extract(frontmatter, '$.tags'), '["VARCHAR"]')) AS tag FROM pages) GROUP BY 1)
SELECT a.tag, b.tag AS near, CAST(levenshtein(a.tag, b.tag) AS INT) AS edits FROM t a JOIN t b ON left(a.tag, 1) = left(b.tag, 1) AND a.tag < b.tag AND levenshtein(a.tag, b.tag) <= 5""")
def similar_tags(spark: SparkSession, folder: str) -> DataFrame:
    """Tags with one first letter and few edits between them; the join runs on the letter."""
    parsed = F.from_json(F.get_json_object("frontmatter", "$.tags"), "array<string>")
    tags = table(spark, folder, "pages").select(F.explode(parsed).alias("tag")).distinct().withColumn("letter", F.substring("tag", 1, 1))
    other = tags.select(F.col("tag").alias("near"), "letter")
    rows = tags.join(other, "letter").where("tag < near").withColumn("edits", F.levenshtein("tag", "near"))
    return rows.where("edits <= 5").select("tag", "near", "edits")


@query(f"""WITH h AS (SELECT k.id, k.page_id, p.type, k.score FROM {_KEYWORD} k JOIN {_LIVE} p ON p.id = k.page_id), a AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY score DESC, id) <= 3),
b AS (SELECT * FROM a ORDER BY score DESC, id LIMIT 30), c AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY type ORDER BY score DESC, id) <= ceil((SELECT count(*) FROM b) * 0.6))
SELECT id, page_id FROM c QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY score DESC, id) <= 2""")
def layered_results(spark: SparkSession, folder: str) -> DataFrame:
    """Result layers over keyword hits: chunks a page, share of a type, chunks a page."""
    hits = search.keyword_hits(_chunks(spark, folder, "page_id", "chunk_text"), ["budget", "pilot"])
    kinds = _live(spark, folder).select(F.col("id").alias("page_id"), "type").distinct()
    return ranking.layered(hits.join(kinds, "page_id"), "page_id", "type", 30).select("id", "page_id")


@query("SELECT id, name, CAST(date_diff('day', CAST(last_sync_at AS DATE), DATE '2026-01-01') AS INT) AS days, last_sync_at IS NULL OR date_diff('day', CAST(last_sync_at AS DATE), DATE '2026-01-01') > 30 AS overdue FROM sources WHERE NOT coalesce(archived, false)")
def sync_age(spark: SparkSession, folder: str) -> DataFrame:
    days = F.date_diff(F.lit("2026-01-01").cast("date"), F.col("last_sync_at").cast("date"))
    rows = table(spark, folder, "sources").where("NOT coalesce(archived, false)")
    return rows.select("id", "name", days.alias("days"), (F.col("last_sync_at").isNull() | (days > 30)).alias("overdue"))


@query(f"""SELECT lower(trim(title)) AS name, count(DISTINCT source_id) AS sources, count(*) AS pages, min(id) AS first_id FROM {_P} WHERE title IS NOT NULL AND type IN ('person', 'company') GROUP BY 1 HAVING count(DISTINCT source_id) > 1""")
def names_across_sources(spark: SparkSession, folder: str) -> DataFrame:
    rows = _pages(spark, folder, "title", "type", "source_id").where("title IS NOT NULL AND type IN ('person', 'company')")
    return rows.groupBy(F.lower(F.trim("title")).alias("name")).agg(F.countDistinct("source_id").alias("sources"), F.count("*").alias("pages"), F.min("id").alias("first_id")).where("sources > 1")
