"""Queries over writes: each gives the state after an operation, beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import graph, pages as page_ops, writes
from ..sources.tables import table
from .derived import derived, sql
from .knowledge import _E, NOW, _chunks, _pages
from .registry import query

_PG = "(SELECT DISTINCT id, source_id, slug, type, title, deleted_at, updated_at, compiled_truth, frontmatter, content_hash, generation FROM pages)"
_T = "(SELECT DISTINCT page_id, date, source, summary FROM timeline_entries)"


# --- pages ------------------------------------------------------------------------------------------


@query(f"""WITH p AS {_PG}, n AS (SELECT source_id, CASE WHEN id % 20 = 0 THEN slug ELSE slug || '-new' END AS slug, CASE WHEN id % 40 = 0 THEN NULL ELSE upper(title) END AS title FROM p WHERE id % 10 = 0)
SELECT source_id, slug, coalesce(n.title, p.title) AS title, p.id IS NULL AS created FROM p FULL JOIN n USING (source_id, slug)""")
def upserted_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages after an upsert by (source_id, slug) in which a null title keeps the old one."""
    pages = _pages(spark, folder, "source_id", "slug", "title")
    slug = F.when(F.col("id") % 20 == 0, F.col("slug")).otherwise(F.concat("slug", F.lit("-new")))
    rows = pages.where("id % 10 = 0").select("source_id", slug.alias("slug"), F.when(F.col("id") % 40 != 0, F.upper("title")).alias("title"))
    return page_ops.upserted(pages, rows, ["source_id", "slug"], keep=["title"]).select("source_id", "slug", "title", F.col("id").isNull().alias("created"))


@query(f"""WITH p AS {_PG} SELECT source_id, slug || '-new' AS slug, DATE '2026-01-01' AS day, 'page created' AS summary FROM p WHERE id % 10 = 0 AND id % 20 <> 0""")
def creation_entries(spark: SparkSession, folder: str) -> DataFrame:
    """The timeline entries that an upsert of pages adds for those it creates."""
    pages = _pages(spark, folder, "source_id", "slug", "title")
    slug = F.when(F.col("id") % 20 == 0, F.col("slug")).otherwise(F.concat("slug", F.lit("-new")))
    rows = pages.where("id % 10 = 0").select("source_id", slug.alias("slug"), "title")
    none = spark.createDataFrame([], "source_id string, slug string, date date, source string, summary string")
    return writes.put_pages(pages, rows, none, NOW)[1].select("source_id", "slug", F.col("date").alias("day"), "summary")


@query(f"SELECT id, slug FROM {_PG} WHERE NOT (source_id = 'default' AND id % 3 = 0)")
def deleted_pages(spark: SparkSession, folder: str) -> DataFrame:
    pages = _pages(spark, folder, "source_id", "slug")
    return writes.deleted(pages, pages.where("source_id = 'default' AND id % 3 = 0"), ["source_id", "slug"]).select("id", "slug")


@query(f"SELECT DISTINCT source_id, slug FROM {_PG} WHERE id % 3 = 0")
def removed_slugs(spark: SparkSession, folder: str) -> DataFrame:
    """The keys that a batch of deletions takes away, of those asked for."""
    pages = _pages(spark, folder, "source_id", "slug")
    asked = pages.where("id % 3 = 0").union(pages.select("id", "source_id", F.concat("slug", F.lit("-unknown"))))
    return writes.removed(pages, asked, ["source_id", "slug"])


@query(f"SELECT id, CASE WHEN id % 4 = 0 THEN coalesce(deleted_at, TIMESTAMP '{NOW}') ELSE deleted_at END AS deleted_at FROM {_PG}")
def soft_deleted_pages(spark: SparkSession, folder: str) -> DataFrame:
    pages = _pages(spark, folder, "source_id", "slug", "deleted_at")
    return page_ops.soft_deleted(pages, pages.where("id % 4 = 0"), NOW).select("id", F.col("deleted_at").cast("timestamp_ntz").alias("deleted_at"))


@query(f"SELECT id, CASE WHEN id % 2 = 0 THEN NULL ELSE deleted_at END AS deleted_at FROM {_PG}")
def restored_pages(spark: SparkSession, folder: str) -> DataFrame:
    pages = _pages(spark, folder, "source_id", "slug", "deleted_at")
    return writes.restored(pages, pages.where("id % 2 = 0")).select("id", "deleted_at")


@query(f"SELECT id FROM {_PG} WHERE deleted_at IS NULL OR deleted_at >= TIMESTAMP '2025-06-01'")
def purged_pages(spark: SparkSession, folder: str) -> DataFrame:
    return page_ops.purged(_pages(spark, folder, "deleted_at"), "2025-06-01").select("id")


@query(f"""SELECT id, CASE WHEN id % 5 = 0 THEN sha256('new ' || CAST(id AS VARCHAR)) ELSE content_hash END AS content_hash FROM {_PG}""")
def refreshed_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """Body and hash alone are replaced."""
    pages = _pages(spark, folder, "compiled_truth", "content_hash")
    body = F.concat(F.lit("new "), F.col("id").cast("string"))
    rows = pages.where("id % 5 = 0").select("id", body.alias("compiled_truth"), F.sha2(body, 256).alias("content_hash"))
    return writes.updated_from(pages, rows, ["id"]).select("id", "content_hash")


@query("""SELECT DISTINCT id, CASE WHEN type = 'note' THEN 'title' ELSE contextual_retrieval_mode END AS mode, CASE WHEN type = 'note' THEN 'g2' ELSE corpus_generation END AS generation FROM pages""")
def stamped_modes(spark: SparkSession, folder: str) -> DataFrame:
    pages = _pages(spark, folder, "type", "contextual_retrieval_mode", "corpus_generation")
    out = writes.updated_where(pages, F.col("type") == "note", contextual_retrieval_mode=F.lit("title"), corpus_generation=F.lit("g2"))
    return out.select("id", F.col("contextual_retrieval_mode").alias("mode"), F.col("corpus_generation").alias("generation"))


@query("""SELECT DISTINCT id, CASE WHEN id % 3 = 0 THEN TIMESTAMP '2026-01-01' WHEN id % 3 = 1 THEN coalesce(updated_at, links_extracted_at) ELSE links_extracted_at END AS at FROM pages""")
def extraction_marks(spark: SparkSession, folder: str) -> DataFrame:
    """A batch of stamps with times of their own, or the default where they have none."""
    pages = _pages(spark, folder, "updated_at", "links_extracted_at")
    at = F.when(F.col("id") % 3 == 0, F.to_timestamp_ntz(F.lit(NOW))).otherwise(F.col("updated_at"))
    return writes.updated_from(pages, pages.where("id % 3 < 2").select("id", at.alias("links_extracted_at")), ["id"], overwrite=False).select("id", F.col("links_extracted_at").alias("at"))


@query(f"""SELECT id, CASE WHEN id % 6 = 0 THEN CAST(CAST(id % 10 AS DOUBLE) / 10 AS FLOAT) ELSE emotional_weight END AS weight FROM (SELECT DISTINCT id, emotional_weight FROM pages)""")
def reweighted_pages(spark: SparkSession, folder: str) -> DataFrame:
    pages = _pages(spark, folder, "emotional_weight")
    rows = pages.where("id % 6 = 0").select("id", ((F.col("id") % 10).cast("double") / 10).cast("float").alias("emotional_weight"))
    return writes.updated_from(pages, rows, ["id"]).select("id", F.col("emotional_weight").alias("weight"))


@query(f"""WITH p AS {_PG} SELECT id, CASE WHEN slug = (SELECT min(slug) FROM p) THEN 'renamed/page' ELSE slug END AS slug FROM p""")
def renamed_slug(spark: SparkSession, folder: str) -> DataFrame:
    pages = _pages(spark, folder, "slug")
    first = pages.agg(F.min("slug").alias("slug")).select("slug", F.lit("renamed/page").alias("to"))
    return pages.join(first, "slug", "left").select("id", F.coalesce("to", "slug").alias("slug"))


@query(f"""SELECT id, CASE WHEN starts_with(slug, 'people/') THEN 'contact' WHEN starts_with(slug, 'companies/') THEN 'account' ELSE 'other' END AS type FROM {_PG}""")
def types_by_prefix(spark: SparkSession, folder: str) -> DataFrame:
    """Untyped pages typed by the longest prefix of their slug."""
    pages = _pages(spark, folder, "slug").withColumn("type", F.lit(None).cast("string"))
    return writes.typed_by_prefix(pages, {"": "other", "people/": "contact", "companies/": "account"}).select("id", "type")


@query(f"""SELECT id, CASE WHEN type = 'note' AND regexp_matches(coalesce(title, ''), '(?i)log') THEN 'log' ELSE type END AS type FROM {_PG}""")
def retyped_pages(spark: SparkSession, folder: str) -> DataFrame:
    pages = _pages(spark, folder, "type", "title")
    return writes.updated_where(pages, (F.col("type") == "note") & F.coalesce("title", F.lit("")).rlike("(?i)log"), type=F.lit("log")).select("id", "type")


@query(f"SELECT id, CAST(CASE WHEN id % 9 = 0 THEN 1 WHEN id % 4 = 0 THEN generation + 1 ELSE generation END AS BIGINT) AS generation FROM {_PG}")
def bumped_generations(spark: SparkSession, folder: str) -> DataFrame:
    """The generation of pages whose content changed goes up by one; new pages begin at one."""
    pages = _pages(spark, folder, "title", "compiled_truth", "generation")
    after = writes.updated_where(pages, F.col("id") % 4 == 0, compiled_truth=F.concat(F.coalesce("compiled_truth", F.lit("")), F.lit(" more")))
    return writes.generation_bumped(pages.where("id % 9 <> 0"), after, "id", ["title", "compiled_truth"]).select("id", "generation")


# --- versions, configuration, logs ------------------------------------------------------------------


@query(f"""SELECT id AS page_id, length(compiled_truth) AS chars, TIMESTAMP '{NOW}' AS snapshot_at FROM {_PG}""")
def page_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    found = writes.snapshots(_pages(spark, folder, "compiled_truth", "frontmatter"), NOW)
    return found.select("page_id", F.length("compiled_truth").alias("chars"), "snapshot_at")


@query(f"""SELECT id, sha256(coalesce(CASE WHEN id % 8 = 0 THEN 'later ' || compiled_truth ELSE compiled_truth END, '')) AS body FROM {_PG}""")
def reverted_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Some pages set back to the latest of two versions."""
    pages = _pages(spark, folder, "compiled_truth", "frontmatter")
    some = pages.where("id % 8 = 0")
    versions = writes.snapshots(some, "2025-01-01 00:00:00").union(writes.snapshots(some.withColumn("compiled_truth", F.concat(F.lit("later "), "compiled_truth")), NOW))
    return writes.reverted(pages, versions).select("id", F.sha2(F.coalesce("compiled_truth", F.lit("")), 256).alias("body"))


@query("""SELECT id, json_extract_string(json_merge_patch(config, '{"federated": "no", "team": "data"}'), '$.federated') AS federated, json_extract_string(json_merge_patch(config, '{"federated": "no", "team": "data"}'), '$.team') AS team FROM sources""")
def patched_configs(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "sources").select("id", writes.merged_json(F.col("config"), {"federated": "no", "team": "data", "gone": None}).alias("c"))
    return rows.select("id", F.get_json_object("c", "$.federated").alias("federated"), F.get_json_object("c", "$.team").alias("team"))


@query("""SELECT event_type AS kind, CAST(ts AS DATE) AS day, CAST(count(*) + count(*) FILTER (user_id % 2 = 0) AS BIGINT) AS events, round(sum(value) + coalesce(sum(value) FILTER (user_id % 2 = 0), 0), 2) AS total FROM events GROUP BY ALL""")
def merged_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """A daily rollup with further counts added to it."""
    events = table(spark, folder, "events").select(F.col("event_type").alias("kind"), F.col("ts").cast("date").alias("day"), F.lit(1).cast("bigint").alias("events"), F.col("value").alias("total"), "user_id")
    totals = events.groupBy("kind", "day").agg(F.sum("events").alias("events"), F.sum("total").alias("total"))
    return writes.added_counts(totals, events.where("user_id % 2 = 0"), ["kind", "day"], ["events", "total"]).withColumn("total", F.round("total", 2))


@query("SELECT event_id AS id FROM events WHERE ts >= TIMESTAMP '2024-01-15'")
def retained_events(spark: SparkSession, folder: str) -> DataFrame:
    """Retention: captured rows from a moment on."""
    return writes.kept_since(table(spark, folder, "events"), "ts", "2024-01-15").select(F.col("event_id").alias("id"))


@query(f"""WITH f AS {sql("captured")} SELECT id, query FROM f UNION ALL SELECT (SELECT max(id) FROM f) + row_number() OVER (ORDER BY created_at, id), query || ' again' FROM f WHERE tool = 'purchase'""")
def appended_queries(spark: SparkSession, folder: str) -> DataFrame:
    """Captured queries with more appended under ids that go on, in order, given range by range."""
    rows = derived(spark, folder, "captured")
    again = rows.where("tool = 'purchase'").withColumn("query", F.concat("query", F.lit(" again")))
    return writes.numbered(rows, again, "id", ["created_at", "id"]).select("id", "query")


# --- chunks -----------------------------------------------------------------------------------------


@query("""WITH c AS (SELECT page_id, chunk_index, min(chunk_text) AS chunk_text, count(embedding) > 0 AS vector FROM content_chunks GROUP BY ALL), m AS (SELECT page_id, chunk_index, CASE WHEN chunk_index % 2 = 0 THEN chunk_text ELSE 'changed' END AS t, vector, chunk_text FROM c WHERE page_id % 3 = 0 AND chunk_index < 3)
SELECT page_id, chunk_index, md5(coalesce(chunk_text, '')) AS body, vector FROM c WHERE page_id % 3 <> 0 OR page_id IS NULL UNION ALL SELECT page_id, chunk_index, md5(coalesce(t, '')), vector AND t IS NOT DISTINCT FROM chunk_text FROM m""")
def remade_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """A third of the pages chunked anew: later chunks vanish, kept texts keep their vectors, changed ones lose them."""
    rows = table(spark, folder, "content_chunks").groupBy("page_id", "chunk_index").agg(F.min("chunk_text").alias("chunk_text"), F.first("embedding", ignorenulls=True).alias("embedding"), F.max("embedded_at").alias("embedded_at"))
    new = rows.where("page_id % 3 = 0 AND chunk_index < 3")
    made = new.select("page_id", "chunk_index", F.when(F.col("chunk_index") % 2 == 0, F.col("chunk_text")).otherwise("changed").alias("chunk_text"), F.lit(None).cast("array<float>").alias("embedding"), F.lit(None).cast("timestamp_ntz").alias("embedded_at"))
    pages = table(spark, folder, "content_chunks").where("page_id % 3 = 0").select("page_id")
    out = writes.put_chunks(rows, made, pages)
    return out.select("page_id", "chunk_index", F.md5(F.coalesce("chunk_text", F.lit(""))).alias("body"), F.col("embedding").isNotNull().alias("vector"))


@query("SELECT DISTINCT id, embedding IS NOT NULL AND model IS NOT DISTINCT FROM 'embed-large-v3' AS vector FROM content_chunks")
def invalidated_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors of another model become null. Whether there is one is asked before rows are made distinct."""
    rows = table(spark, folder, "content_chunks").select("id", "model", "embedding", "embedded_at")
    return writes.invalidated(rows, "embed-large-v3").select("id", F.col("embedding").isNotNull().alias("vector")).distinct()


@query("SELECT DISTINCT id, page_id FROM content_chunks WHERE page_id % 5 <> 0")
def dropped_chunks(spark: SparkSession, folder: str) -> DataFrame:
    rows = _chunks(spark, folder, "page_id")
    return writes.deleted(rows, rows.where("page_id % 5 = 0"), ["page_id"])


# --- links, tags, timeline --------------------------------------------------------------------------


@query(f"""WITH p AS (SELECT DISTINCT id, slug, source_id FROM pages), w AS (SELECT f.id AS a, f.source_id, f.slug AS from_slug, t.slug AS to_slug, l.link_type FROM (SELECT DISTINCT * FROM links) l JOIN p f ON f.id = l.from_page_id JOIN p t ON t.id = l.to_page_id WHERE l.id % 2 = 0),
n AS (SELECT DISTINCT a.id AS src, b.id AS dst, w.link_type FROM w JOIN p a ON a.slug = w.from_slug AND a.source_id = w.source_id JOIN p b ON b.slug = w.to_slug AND b.source_id = w.source_id)
SELECT src, dst, link_type, 'batch' AS link_source FROM n UNION ALL SELECT * FROM {_E}""")
def inserted_links(spark: SparkSession, folder: str) -> DataFrame:
    """A batch of edges given by slugs, resolved at both ends and added where they are new."""
    pages = _pages(spark, folder, "slug", "source_id")
    links = table(spark, folder, "links").select("id", "from_page_id", "to_page_id", "link_type").distinct().where("id % 2 = 0")
    one = pages.select(F.col("id").alias("from_page_id"), F.col("slug").alias("from_slug"), "source_id")
    two = pages.select(F.col("id").alias("to_page_id"), F.col("slug").alias("to_slug"))
    rows = links.join(one, "from_page_id").join(two, "to_page_id").select("from_slug", "to_slug", F.lit("no such page").alias("origin_slug"), "source_id", "link_type", F.lit("batch").alias("link_source")).distinct()
    state = graph.edges(table(spark, folder, "links")).withColumn("origin", F.lit(None).cast("int"))
    return writes.put_links(state, rows, pages).select("src", "dst", "link_type", "link_source")


@query(f"SELECT src, dst, link_type, link_source FROM {_E} WHERE NOT (link_type IS NOT DISTINCT FROM 'mentions' AND link_source IS NULL)")
def removed_links(spark: SparkSession, folder: str) -> DataFrame:
    """Edges deleted by their whole key, null-safely."""
    found = graph.edges(table(spark, folder, "links"))
    return writes.deleted(found, found.where("link_type = 'mentions' AND link_source IS NULL"), ["src", "dst", "link_type", "link_source"])


@query(f"""SELECT CASE WHEN src % 10 = 0 THEN src + 1 ELSE src END AS src, CASE WHEN dst % 10 = 0 THEN dst + 1 ELSE dst END AS dst, link_type FROM {_E}""")
def repointed_links(spark: SparkSession, folder: str) -> DataFrame:
    """Both ends of all edges moved from merged pages to the pages that took their place."""
    found = graph.edges(table(spark, folder, "links"))
    old = found.select(F.explode(F.array("src", "dst")).alias("old")).where("old % 10 = 0").distinct()
    return writes.repointed(found, old.withColumn("new", F.col("old") + 1), ["src", "dst"]).select("src", "dst", "link_type")


_TAGS = """(SELECT DISTINCT id AS page_id, unnest(from_json(json_extract(frontmatter, '$.tags'), '["VARCHAR"]')) AS tag FROM pages)"""


def tag_rows(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, tag)."""
    rows = table(spark, folder, "pages").where("frontmatter LIKE '%tags%'")
    return rows.select(F.col("id").alias("page_id"), F.explode(F.from_json(F.get_json_object("frontmatter", "$.tags"), "array<string>")).alias("tag")).distinct()


@query(f"SELECT page_id, tag FROM {_TAGS} UNION SELECT id, 'reviewed' FROM pages WHERE type = 'meeting' UNION SELECT page_id, tag FROM {_TAGS}")
def added_tags(spark: SparkSession, folder: str) -> DataFrame:
    tags = tag_rows(spark, folder)
    new = table(spark, folder, "pages").where("type = 'meeting'").select(F.col("id").alias("page_id"), F.lit("reviewed").alias("tag"))
    return page_ops.insert_ignore(tags, new.union(tags), ["page_id", "tag"])


@query(f"SELECT page_id, tag FROM {_TAGS} WHERE NOT (tag = (SELECT min(tag) FROM {_TAGS}) AND page_id % 2 = 0)")
def removed_tags(spark: SparkSession, folder: str) -> DataFrame:
    tags = tag_rows(spark, folder)
    first = tags.agg(F.min("tag").alias("tag"))
    return writes.deleted(tags, tags.join(first, "tag", "left_semi").where("page_id % 2 = 0"), ["page_id", "tag"])


@query(f"""SELECT page_id, date AS day, source, summary FROM {_T} UNION ALL SELECT DISTINCT page_id, date, 'batch', summary FROM {_T} WHERE page_id % 7 = 0 AND source IS DISTINCT FROM 'batch'""")
def inserted_entries(spark: SparkSession, folder: str) -> DataFrame:
    """Timeline entries added in a batch; those that are there already are passed over."""
    rows = table(spark, folder, "timeline_entries").select("page_id", "date", "source", "summary").distinct()
    some = rows.where("page_id % 7 = 0")
    new = some.withColumn("source", F.lit("batch")).union(some)
    return page_ops.insert_ignore(rows, new, ["page_id", "date", "source", "summary"]).select("page_id", F.col("date").alias("day"), "source", "summary")


@query("""SELECT DISTINCT id AS page_id, lower(title) AS alias FROM pages WHERE title IS NOT NULL AND id % 2 = 1 UNION ALL SELECT DISTINCT id, 'only ' || CAST(id AS VARCHAR) FROM pages WHERE title IS NOT NULL AND id % 2 = 0""")
def replaced_aliases(spark: SparkSession, folder: str) -> DataFrame:
    """The alias set of some pages replaced as a whole."""
    state = _pages(spark, folder, "title").where("title IS NOT NULL").select(F.col("id").alias("page_id"), F.lower("title").alias("alias"))
    new = state.where("page_id % 2 = 0").select("page_id", F.concat(F.lit("only "), F.col("page_id").cast("string")).alias("alias"))
    return writes.replaced(state, new, ["page_id"])


# --- claims, facts, files ---------------------------------------------------------------------------


@query(f"""WITH c AS {sql("claims")}, o AS (SELECT page_id, row_num FROM c WHERE active AND quality IS NULL AND row_num <= 2), l AS (SELECT page_id, max(row_num) AS last FROM c GROUP BY 1),
n AS (SELECT o.*, CAST(last + row_number() OVER (PARTITION BY page_id ORDER BY row_num) AS INT) AS new FROM o JOIN l USING (page_id))
SELECT c.page_id, c.row_num, c.active AND n.new IS NULL AS active, n.new AS superseded_by FROM c LEFT JOIN n USING (page_id, row_num) UNION ALL SELECT page_id, new, true, NULL FROM n""")
def superseded_claims(spark: SparkSession, folder: str) -> DataFrame:
    """Open claims replaced by new ones with the next row numbers; resolved ones are refused."""
    claims = derived(spark, folder, "claims")
    rows = claims.where("row_num <= 2").select("page_id", F.col("row_num").alias("old_row"), F.concat("claim", F.lit(" (revised)")).alias("claim"), "weight")
    return writes.superseded(claims, rows).select("page_id", "row_num", "active", "superseded_by")


@query(f"""SELECT page_id, row_num, CASE WHEN quality IS NULL AND row_num = 1 THEN 'correct' ELSE quality END AS quality FROM {sql("claims")}""")
def resolved_claims(spark: SparkSession, folder: str) -> DataFrame:
    """Resolutions are written once: those of resolved claims stay."""
    claims = derived(spark, folder, "claims")
    rows = claims.where("row_num = 1").select("page_id", "row_num", F.lit("correct").alias("quality"))
    return writes.updated_from(claims, rows, ["page_id", "row_num"], where=F.col("quality").isNull()).select("page_id", "row_num", "quality")


@query(f"""SELECT page_id, row_num, CASE WHEN row_num = 1 THEN 0.5 ELSE weight END AS weight, since_date FROM {sql("claims")}""")
def updated_claims(spark: SparkSession, folder: str) -> DataFrame:
    """Only the fields that are given change."""
    claims = derived(spark, folder, "claims")
    rows = claims.where("row_num = 1").select("page_id", "row_num", F.lit(0.5).cast("double").alias("weight"), F.lit(None).cast("date").alias("since_date"))
    return writes.updated_from(claims, rows, ["page_id", "row_num"], overwrite=False).select("page_id", "row_num", "weight", "since_date")


@query(f"""WITH f AS {sql("facts")}, n AS (SELECT id + 1000000000 AS id, id AS supersedes FROM f WHERE id % 3 = 0)
SELECT f.id, CASE WHEN n.id IS NOT NULL AND expired_at IS NULL THEN TIMESTAMP '{NOW}' ELSE expired_at END AS expired_at, CASE WHEN n.id IS NOT NULL AND expired_at IS NULL THEN n.id ELSE superseded_by END AS superseded_by
FROM f LEFT JOIN n ON n.supersedes = f.id UNION ALL SELECT id, NULL, NULL FROM n""")
def inserted_facts(spark: SparkSession, folder: str) -> DataFrame:
    """New facts appended; those they supersede expire and name their successors."""
    facts = derived(spark, folder, "facts").select("id", "fact", "valid_from", "expired_at", "superseded_by")
    new = facts.where("id % 3 = 0").select((F.col("id") + 1_000_000_000).alias("id"), F.upper("fact").alias("fact"), "valid_from", F.col("id").alias("supersedes"))
    return writes.inserted_facts(facts, new, NOW).select("id", "expired_at", "superseded_by")


@query(f"""SELECT id, CASE WHEN id % 4 = 1 THEN coalesce(valid_until, DATE '2026-01-01') ELSE valid_until END AS valid_until FROM {sql("facts")}""")
def closed_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Validity is closed once; closing again changes nothing."""
    facts = derived(spark, folder, "facts")
    close = lambda df: writes.updated_where(df, (F.col("id") % 4 == 1) & F.col("valid_until").isNull(), valid_until=F.to_date(F.lit("2026-01-01")))
    return close(close(facts)).select("id", "valid_until")


@query(f"""SELECT id FROM {sql("facts")} WHERE entity_id % 2 = 1 OR kind LIKE 'meet%' OR kind LIKE 'imp%'""")
def cleared_facts(spark: SparkSession, folder: str) -> DataFrame:
    """The facts of some pages deleted but for those whose kind has an excluded prefix."""
    facts = derived(spark, folder, "facts")
    kept = F.col("kind").startswith("meet") | F.col("kind").startswith("imp")
    return writes.deleted(facts, facts.where((F.col("entity_id") % 2 == 0) & ~kept), ["id"]).select("id")


@query(f"""SELECT id, CASE WHEN entity_id % 10 = 0 THEN entity_id + 1 ELSE entity_id END AS entity_id FROM {sql("facts")}""")
def rekeyed_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Facts of phantom entities moved to the canonical ones."""
    facts = derived(spark, folder, "facts")
    moves = facts.where("entity_id % 10 = 0").select(F.col("entity_id").alias("old"), (F.col("entity_id") + 1).alias("new")).distinct()
    return writes.repointed(facts, moves, ["entity_id"]).select("id", "entity_id")


@query(f"""WITH f AS {sql("files")} SELECT source_id, storage_path, max(CASE WHEN page_id % 2 = 0 THEN size + 1 ELSE size END) AS size FROM f GROUP BY ALL""")
def upserted_files(spark: SparkSession, folder: str) -> DataFrame:
    """File rows by (source, path): known ones replaced."""
    files = derived(spark, folder, "files").groupBy("source_id", "storage_path", "page_id").agg(F.max("size").alias("size"))
    rows = files.where("page_id % 2 = 0").select("source_id", "storage_path", (F.col("size") + 1).alias("size"))
    return page_ops.upserted(files, rows, ["source_id", "storage_path"]).select("source_id", "storage_path", "size")


@query(f"""SELECT page_id, row_num, CASE WHEN holder = 'holder-3' AND quality IS NOT NULL THEN NULL ELSE quality END AS quality FROM {sql("claims")} WHERE NOT (holder = 'holder-4' AND row_num > 1)""")
def undone_wave(spark: SparkSession, folder: str) -> DataFrame:
    """A wave of writes rolled back: its resolutions are lifted, its rows removed."""
    claims = derived(spark, folder, "claims")
    lifted = writes.updated_where(claims, (F.col("holder") == "holder-3") & F.col("quality").isNotNull(), quality=F.lit(None))
    return writes.deleted(lifted, claims.where("holder = 'holder-4' AND row_num > 1"), ["page_id", "row_num"]).select("page_id", "row_num", "quality")


@query("""SELECT DISTINCT key, value FROM (SELECT id AS key, config AS value, id FROM sources) WHERE key <> 'default' UNION ALL SELECT 'limit', '20'""")
def key_values(spark: SparkSession, folder: str) -> DataFrame:
    """A key-value table after one upsert and one deletion."""
    state = table(spark, folder, "sources").select(F.col("id").alias("key"), F.col("config").alias("value"))
    new = spark.range(1).select(F.lit("limit").alias("key"), F.lit("20").alias("value"))
    return writes.deleted(page_ops.upserted(state, new, ["key"]), state.where("key = 'default'"), ["key"])


_CALLS = r"""(SELECT DISTINCT id AS chunk_id, unnest(regexp_extract_all(chunk_text, '\b([a-z_][a-z0-9_]*)\(', 1)) AS callee FROM content_chunks WHERE language IS NOT NULL)"""


def calls(spark: SparkSession, folder: str) -> DataFrame:
    """(chunk_id, callee): the names called in code chunks."""
    rows = table(spark, folder, "content_chunks").where("language IS NOT NULL").select("id", "chunk_text").distinct()
    return rows.select(F.col("id").alias("chunk_id"), F.explode(F.regexp_extract_all("chunk_text", F.lit(r"\b([a-z_][a-z0-9_]*)\("), 1)).alias("callee")).distinct()


_DEFS = "(SELECT symbol_name, min(id) AS to_chunk FROM content_chunks WHERE symbol_name IS NOT NULL GROUP BY 1)"


@query(f"SELECT c.chunk_id, callee, d.to_chunk, d.to_chunk IS NOT NULL AS resolved FROM {_CALLS} c LEFT JOIN {_DEFS} d ON d.symbol_name = c.callee")
def stored_code_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Call edges parted into resolved ones (with the chunk that defines the name) and others, as one union."""
    found, known = calls(spark, folder), table(spark, folder, "content_chunks").where("symbol_name IS NOT NULL").groupBy(F.col("symbol_name").alias("callee")).agg(F.min("id").alias("to_chunk"))
    met = found.join(known, "callee", "left")
    resolved = met.where("to_chunk IS NOT NULL").select("chunk_id", "callee", "to_chunk", F.lit(True).alias("resolved"))
    return resolved.union(met.where("to_chunk IS NULL").select("chunk_id", "callee", "to_chunk", F.lit(False)))


@query(f"SELECT chunk_id, callee FROM {_CALLS} WHERE chunk_id % 3 <> 0")
def dropped_code_edges(spark: SparkSession, folder: str) -> DataFrame:
    found = calls(spark, folder)
    return writes.deleted(found, found.where("chunk_id % 3 = 0"), ["chunk_id"])


@query(f"""SELECT page_id, max(created_at) AS last_seen FROM (SELECT DISTINCT page_id, created_at, lag(created_at) OVER (PARTITION BY page_id ORDER BY created_at) AS before FROM (SELECT DISTINCT page_id, created_at FROM timeline_entries))
WHERE before IS NULL OR created_at >= before + INTERVAL 5 MINUTE GROUP BY 1""")
def throttled_access(spark: SparkSession, folder: str) -> DataFrame:
    """The last access of each page that came five minutes or more after the one before."""
    rows = table(spark, folder, "timeline_entries").select("page_id", "created_at").distinct()
    before = F.lag("created_at").over(Window.partitionBy("page_id").orderBy("created_at"))
    spaced = rows.withColumn("before", before).where("before IS NULL OR created_at >= before + INTERVAL 5 MINUTE")
    return spaced.groupBy("page_id").agg(F.max("created_at").alias("last_seen"))
