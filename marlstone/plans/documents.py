"""Queries over documents, code, coverage and rankings, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scores
from ..operators import documents, graph, search, series
from ..sources.tables import table
from .knowledge import _C, _E, _P, _chunks, _jobs, _pages, _LATEST
from .registry import query

_LINES = r"(SELECT {key}, generate_subscripts(l, 1) - 1 AS line_no, unnest(l) AS line FROM (SELECT DISTINCT {key}, regexp_split_to_array({text}, '\r?\n') AS l FROM {table} WHERE {text} IS NOT NULL AND {where}))"
_DOC_LINES = _LINES.format(key="doc_id", text="text", table="documents", where="{where}")


@query(rf"SELECT doc_id, line_no, length(regexp_extract(line, '^(#{{1,6}}) +(.*?) *$', 1)) AS level, regexp_extract(line, '^(#{{1,6}}) +(.*?) *$', 2) AS heading FROM {_DOC_LINES.format(where='true')} WHERE regexp_matches(line, '^(#{{1,6}}) +(.*?) *$')")
def outlines(spark: SparkSession, folder: str) -> DataFrame:
    return documents.headings(table(spark, folder, "documents"), "doc_id", "text")


@query(rf"""SELECT doc_id, line_no, len(string_split(trim(line), '|')) - 2 AS cells, trim(string_split(trim(line), '|')[2]) AS first FROM {_DOC_LINES.format(where='true')}
WHERE regexp_matches(trim(line), '^\|.*\|$') AND NOT regexp_matches(trim(line), '^\|[ :|-]+\|$')""")
def embedded_tables(spark: SparkSession, folder: str) -> DataFrame:
    rows = documents.table_rows(table(spark, folder, "documents"), "doc_id", "text")
    return rows.select("doc_id", "line_no", F.size("cells").alias("cells"), F.col("cells")[0].alias("first"))


@query(r"""SELECT doc_id, regexp_extract(b, '(?m)^title:[ \t]*(.*?)[ \t\r]*$', 1) AS title FROM (SELECT doc_id, regexp_extract(text, '\A(?s:---\r?\n(.*?)\r?\n---)', 1) AS b FROM documents WHERE text IS NOT NULL)
WHERE regexp_extract(b, '(?m)^title:[ \t]*(.*?)[ \t\r]*$', 1) <> ''""")
def front_titles(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").where("text IS NOT NULL").select("doc_id", documents.front_matter(F.col("text"), "title").alias("title"))
    return rows.where("title IS NOT NULL")


@query(rf"""SELECT DISTINCT id, try_cast(regexp_extract(line, '^- \*\*(\d{{4}}-\d{{2}}-\d{{2}})\*\* \| ([^—\n]*?) — (.*)$', 1) AS DATE) AS day, regexp_extract(line, '^- \*\*(\d{{4}}-\d{{2}}-\d{{2}})\*\* \| ([^—\n]*?) — (.*)$', 2) AS source
FROM {_LINES.format(key="id", text="timeline", table="pages", where="true")} WHERE regexp_matches(line, '^- \*\*(\d{{4}}-\d{{2}}-\d{{2}})\*\* \| ([^—\n]*?) — (.*)$')""")
def timeline_lines(spark: SparkSession, folder: str) -> DataFrame:
    return documents.timeline_rows(table(spark, folder, "pages"), "id", "timeline").select("id", "day", "source").distinct()


_KIND = "CASE symbol_type WHEN 'class' THEN 0 WHEN 'interface' THEN 1 WHEN 'function' THEN 2 WHEN 'method' THEN 3 ELSE 4 END"


@query(f"""SELECT symbol_name, id AS chunk_id, symbol_type FROM (SELECT *, row_number() OVER (PARTITION BY symbol_name ORDER BY {_KIND}, id) AS n FROM (SELECT DISTINCT id, symbol_name, symbol_type FROM content_chunks WHERE symbol_name IS NOT NULL)) WHERE n = 1""")
def symbol_definitions(spark: SparkSession, folder: str) -> DataFrame:
    """One definition of each symbol by the priority of its kind."""
    rows = _chunks(spark, folder, "symbol_name", "symbol_type").where("symbol_name IS NOT NULL")
    best = rows.groupBy("symbol_name").agg(F.min(F.struct(F.expr(_KIND).alias("p"), "id", "symbol_type")).alias("b"))
    return best.select("symbol_name", F.col("b.id").alias("chunk_id"), F.col("b.symbol_type").alias("symbol_type"))


@query("SELECT language, symbol_type, count(DISTINCT id) AS chunks, count(DISTINCT symbol_name_qualified) AS symbols, CAST(max(end_line - start_line + 1) AS INT) AS longest FROM content_chunks WHERE language IS NOT NULL GROUP BY ALL")
def code_inventory(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "content_chunks").where("language IS NOT NULL")
    size = F.max(F.col("end_line") - F.col("start_line") + 1)
    return rows.groupBy("language", "symbol_type").agg(F.countDistinct("id").alias("chunks"), F.countDistinct("symbol_name_qualified").alias("symbols"), size.alias("longest"))


@query("SELECT DISTINCT p.id FROM pages p WHERE NOT EXISTS (SELECT 1 FROM content_chunks c WHERE c.page_id = p.id) AND coalesce(p.compiled_truth, '') <> ''")
def unchunked_pages(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").where("coalesce(compiled_truth, '') <> ''").select("id").distinct()
    return pages.join(table(spark, folder, "content_chunks").select(F.col("page_id").alias("id")), "id", "left_anti")


@query(f"""SELECT page_id, chunk_index FROM (SELECT page_id, chunk_index, chunk_index - lag(chunk_index, 1, -1) OVER (PARTITION BY page_id ORDER BY chunk_index) AS step FROM (SELECT DISTINCT page_id, chunk_index FROM content_chunks)) WHERE step > 1""")
def chunk_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Chunk indexes whose predecessor is missing: an anti-join on both keys, so no page is gathered in one task."""
    rows = table(spark, folder, "content_chunks").select("page_id", "chunk_index").distinct()
    before = rows.select("page_id", (F.col("chunk_index") + 1).alias("chunk_index"))
    return rows.where("chunk_index > 0").join(before, ["page_id", "chunk_index"], "left_anti")


@query(f"""WITH v AS (SELECT page_id, chunk_index, id, CAST(embedding AS DOUBLE[]) AS e FROM {_C} WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isnan(x) OR isinf(x))) = 0),
s AS (SELECT page_id, list_cosine_similarity(e, lag(e) OVER (PARTITION BY page_id ORDER BY chunk_index, id)) AS c FROM v)
SELECT page_id, count(*) AS steps, round(1 - avg(coalesce(nullif(c, 'nan'::DOUBLE), 0)), 5) AS drift FROM s WHERE c IS NOT NULL GROUP BY 1 HAVING count(*) >= 2""")
def embedding_drift(spark: SparkSession, folder: str) -> DataFrame:
    """One less the mean cosine of a page's consecutive chunks."""
    rows = table(spark, folder, "content_chunks").where("size(embedding) = 64 AND NOT exists(embedding, x -> isnan(x) OR abs(x) = float('inf'))")
    rows = rows.select("id", "page_id", "chunk_index", "embedding").dropDuplicates(["id"])
    steps = series.lagged(rows, ["page_id"], "chunk_index", "id", "embedding", "before").where("before IS NOT NULL").select("page_id", scores.cosine(F.col("embedding"), F.col("before")).alias("c"))
    return steps.groupBy("page_id").agg(F.count("*").alias("steps"), F.round(1 - F.avg("c"), 5).alias("drift")).where("steps >= 2")


@query(f"""WITH c AS (SELECT count(*) AS n, count(*) FILTER (embedding IS NOT NULL) AS e FROM {_C}), p AS (SELECT count(*) AS n, count(*) FILTER (effective_date IS NOT NULL) AS d FROM {_P} WHERE deleted_at IS NULL),
o AS (SELECT count(*) AS n FROM (SELECT DISTINCT id FROM pages WHERE deleted_at IS NULL) l WHERE NOT EXISTS (SELECT 1 FROM {_E} e JOIN (SELECT DISTINCT id FROM pages WHERE deleted_at IS NULL) f ON f.id = e.src WHERE e.dst = l.id AND e.src <> e.dst))
SELECT round(c.e / c.n, 6) AS embedded, round(p.d / p.n, 6) AS dated, round(1 - o.n / p.n, 6) AS linked, round(100 * (0.5 * c.e / c.n + 0.2 * p.d / p.n + 0.3 * (1 - o.n / p.n)), 4) AS score FROM c, p, o""")
def health(spark: SparkSession, folder: str) -> DataFrame:
    """Coverage ratios and their weighted score, from three one-row aggregates."""
    chunks = _chunks(spark, folder, F.col("embedding").isNotNull().alias("e")).agg(F.avg(F.col("e").cast("double")).alias("embedded"))
    pages = _pages(spark, folder, "deleted_at", "effective_date").where("deleted_at IS NULL")
    dated = pages.agg(F.avg(F.col("effective_date").isNotNull().cast("double")).alias("dated"), F.count("*").alias("n"))
    alone = graph.orphans(table(spark, folder, "pages"), table(spark, folder, "links")).agg(F.count("*").alias("o"))
    out = chunks.crossJoin(dated).crossJoin(alone).withColumn("linked", 1 - F.col("o") / F.col("n"))  # one row each
    score = 100 * (0.5 * F.col("embedded") + 0.2 * F.col("dated") + 0.3 * F.col("linked"))
    return out.select(F.round("embedded", 6).alias("embedded"), F.round("dated", 6).alias("dated"), F.round("linked", 6).alias("linked"), F.round(score, 4).alias("score"))


@query(f"""WITH c AS (SELECT parent_job_id AS id, status, count(*) AS n FROM {_LATEST} WHERE parent_job_id IS NOT NULL GROUP BY ALL)
SELECT id AS job_id, CAST(sum(n) AS BIGINT) AS children, CAST(coalesce(sum(n) FILTER (status = 'completed'), 0) AS BIGINT) AS completed, CAST(coalesce(sum(n) FILTER (status IN ('failed', 'dead')), 0) AS BIGINT) AS failed FROM c GROUP BY 1""")
def job_children(spark: SparkSession, folder: str) -> DataFrame:
    rows = _jobs(spark, folder, "parent_job_id").where("parent_job_id IS NOT NULL")
    return rows.groupBy(F.col("parent_job_id").alias("job_id")).agg(
        F.count("*").alias("children"), F.count_if(F.col("status") == "completed").alias("completed"), F.count_if(F.col("status").isin("failed", "dead")).alias("failed")
    )


@query(f"""WITH r AS (SELECT id, ln(1 + n) AS score FROM (SELECT dst AS id, count(*) AS n FROM {_E} GROUP BY 1) ORDER BY score DESC, id LIMIT 30), g AS (SELECT *, row_number() OVER (ORDER BY score DESC, id) AS place,
(score - lead(score) OVER (ORDER BY score DESC, id)) / max(score) OVER () AS gap FROM r), c AS (SELECT place FROM g WHERE gap >= 0.05 ORDER BY gap DESC, place LIMIT 1)
SELECT id, round(score, 6) AS score FROM g WHERE place <= coalesce((SELECT place FROM c), 30)""")
def cut_at_gap(spark: SparkSession, folder: str) -> DataFrame:
    """A ranking of 30, cut at its largest score gap if that is large enough."""
    counts = graph.edges(table(spark, folder, "links")).groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("n"))
    top = search.ranked(counts.select("id", F.log(1 + F.col("n").cast("double")).alias("score")), 30, "id")
    order = Window.orderBy(F.desc("score"), "id")  # thirty rows
    gaps = top.withColumn("gap", (F.col("score") - F.lead("score").over(order)) / F.max("score").over(Window.partitionBy(F.lit(0))))
    cut = gaps.where("gap >= 0.05").orderBy(F.desc("gap"), "rank").limit(1).agg(F.max("rank").alias("at"))
    return gaps.crossJoin(F.broadcast(cut)).where("at IS NULL OR rank <= at").select("id", F.round("score", 6).alias("score"))


@query(f"""SELECT p.id, round(ln(1 + m.n) * greatest(0.1, exp(-greatest((epoch_us(TIMESTAMP '2026-01-01') - epoch_us(coalesce(p.updated_at, p.created_at))) / 86400000000.0, 0) / 180)), 6) AS score
FROM (SELECT DISTINCT id, type, updated_at, created_at FROM pages WHERE deleted_at IS NULL AND type = 'person') p JOIN (SELECT src AS id, count(*) AS n FROM {_E} GROUP BY 1) m USING (id)""")
def experts(spark: SparkSession, folder: str) -> DataFrame:
    """People by how much they link, fading over half a year."""
    out = graph.edges(table(spark, folder, "links")).groupBy(F.col("src").alias("id")).agg(F.count("*").alias("n"))
    people = _pages(spark, folder, "type", "deleted_at", "updated_at", "created_at").where("deleted_at IS NULL AND type = 'person'").select("id", "updated_at", "created_at").distinct()
    age = F.greatest(scores.age_days(F.coalesce("updated_at", "created_at"), "2026-01-01 00:00:00"), F.lit(0.0))
    return people.join(out, "id").select("id", F.round(F.log(1 + F.col("n").cast("double")) * F.greatest(F.lit(0.1), F.exp(-age / 180)), 6).alias("score"))


@query(f"SELECT id FROM (SELECT DISTINCT id FROM pages) ORDER BY md5('seed-1:' || CAST(id AS VARCHAR)), id LIMIT 50")
def seeded_sample(spark: SparkSession, folder: str) -> DataFrame:
    """A sample that one seed always draws alike, by the order of hashes."""
    rows = table(spark, folder, "pages").select("id").distinct()
    return rows.orderBy(F.md5(F.concat(F.lit("seed-1:"), F.col("id").cast("string"))), "id").limit(50)


@query(f"""SELECT slug, id AS canonical, copies FROM (SELECT slug, id, count(*) OVER (PARTITION BY slug) AS copies, row_number() OVER (PARTITION BY slug ORDER BY coalesce(s.archived, false), p.source_id <> 'default', p.source_id, p.id) AS n
FROM (SELECT DISTINCT id, slug, source_id FROM pages) p JOIN (SELECT id AS source_id, archived FROM sources) s USING (source_id)) WHERE n = 1 AND copies > 1""")
def canonical_slugs(spark: SparkSession, folder: str) -> DataFrame:
    """Of pages that share a slug, the one of the first source by priority: an aggregate over the priority."""
    source = table(spark, folder, "sources").select(F.col("id").alias("source_id"), F.coalesce("archived", F.lit(False)).alias("archived"))
    rows = _pages(spark, folder, "slug", "source_id").join(source, "source_id")
    order = F.struct("archived", (F.col("source_id") != "default").alias("other"), "source_id", "id")
    return rows.groupBy("slug").agg(F.min(order).alias("o"), F.count("*").alias("copies")).where("copies > 1").select("slug", F.col("o.id").alias("canonical"), "copies")


@query(f"""SELECT page_id, count(*) AS entries, CAST(quantile_disc(n, 0.5) AS BIGINT) AS median, CAST(quantile_disc(n, 0.95) AS BIGINT) AS p95 FROM (SELECT page_id, length(summary) AS n FROM (SELECT DISTINCT page_id, date, source, summary FROM timeline_entries) WHERE summary IS NOT NULL) GROUP BY 1""")
def summary_lengths(spark: SparkSession, folder: str) -> DataFrame:
    """Nearest-rank percentiles of each page's summaries."""
    rows = table(spark, folder, "timeline_entries").select("page_id", "date", "source", "summary").distinct().where("summary IS NOT NULL").withColumn("n", F.length("summary"))
    rank = lambda p: F.expr(f"CAST(percentile_disc({p}) WITHIN GROUP (ORDER BY n) AS BIGINT)")
    return rows.groupBy("page_id").agg(F.count("*").alias("entries"), rank(0.5).alias("median"), rank(0.95).alias("p95"))


@query("""WITH t AS (SELECT DISTINCT id, unnest(from_json(json_extract(frontmatter, '$.tags'), '["VARCHAR"]')) AS tag FROM pages)
SELECT a.tag AS tag_a, b.tag AS tag_b, count(*) AS pages FROM t a JOIN t b ON a.id = b.id AND a.tag < b.tag GROUP BY ALL""")
def tag_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Tags that stand together: pairs are made inside each page's own short array."""
    parsed = F.array_sort(F.array_distinct(F.from_json(F.get_json_object("frontmatter", "$.tags"), "array<string>")))
    rows = table(spark, folder, "pages").select("id", parsed.alias("tags")).distinct()
    pairs = F.flatten(F.transform("tags", lambda a: F.transform(F.filter("tags", lambda b: b > a), lambda b: F.struct(a.alias("tag_a"), b.alias("tag_b")))))
    return rows.select(F.explode(pairs).alias("p")).select("p.*").groupBy("tag_a", "tag_b").agg(F.count("*").alias("pages"))


@query(r"""SELECT lang, kind, count(*) AS documents, CAST(sum(n) AS BIGINT) AS chars, CAST(max(n) AS BIGINT) AS longest, count(*) FILTER (NOT regexp_matches(coalesce(text, ''), '[^ \t\n\r]')) AS blank FROM (SELECT lower(lang) AS lang, kind, text, coalesce(length(text), 0) AS n FROM documents) GROUP BY GROUPING SETS ((lang, kind), (lang), ())""")
def corpus_profile(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select(F.lower("lang").alias("lang"), "kind", F.coalesce(F.length("text"), F.lit(0)).alias("n"), (~F.coalesce("text", F.lit("")).rlike(r"[^ \t\n\r]")).alias("b"))
    out = rows.groupingSets([["lang", "kind"], ["lang"], []], "lang", "kind")
    return out.agg(F.count("*").alias("documents"), F.sum("n").cast("bigint").alias("chars"), F.max("n").cast("bigint").alias("longest"), F.count_if("b").alias("blank"))
