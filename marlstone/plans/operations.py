"""The named operations as queries: what each gives, or the state it leaves, beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..api import Store
from .derived import sql
from .knowledge import _E, _J, NOW
from .rankings import _CALLS
from .registry import query
from .searching import _KARM, ASKED
from .writes import _TAGS

LOG = {"slug": "inbox/capture-log", "source_id": "capture-inbox"}
_LOG = "(slug = 'inbox/capture-log' AND source_id = 'capture-inbox')"
_C, _FA, _FI = sql("claims"), sql("facts"), sql("files")
_HUB = "(SELECT id, slug, source_id FROM (SELECT p.id, p.slug, p.source_id, count(*) AS n FROM (SELECT DISTINCT id, slug, source_id FROM pages) p JOIN (SELECT DISTINCT from_page_id, to_page_id FROM links) l ON l.to_page_id = p.id GROUP BY ALL) ORDER BY n DESC, id LIMIT 1)"
_HUBS = "(SELECT id, slug, source_id FROM (SELECT p.id, p.slug, p.source_id, count(*) AS n FROM (SELECT DISTINCT id, slug, source_id FROM pages) p JOIN (SELECT DISTINCT from_page_id, to_page_id FROM links) l ON l.from_page_id = p.id GROUP BY ALL) ORDER BY n DESC, id LIMIT 1)"


def _hub(store: Store, end: str) -> dict[str, str]:
    """The page with the most links at one end: one row."""
    pages = store["pages"].select("id", "slug", "source_id").distinct()
    n = store["links"].select("from_page_id", "to_page_id").distinct().groupBy(F.col(end).alias("id")).agg(F.count("*").alias("n"))
    row = pages.join(n, "id").orderBy(F.desc("n"), "id").first()
    return {"slug": row["slug"], "source_id": row["source_id"]}


@query(f"SELECT DISTINCT id, title, md5(coalesce(compiled_truth, '')) AS body FROM pages WHERE {_LOG} AND deleted_at IS NULL")
def op_get_page(spark: SparkSession, folder: str) -> DataFrame:
    return Store(spark, folder).run("get_page", **LOG).select("id", "title", F.md5(F.coalesce("compiled_truth", F.lit(""))).alias("body"))


@query(f"""SELECT DISTINCT slug, md5(CASE WHEN {_LOG} THEN 'new body' ELSE coalesce(compiled_truth, '') END) AS body FROM pages UNION ALL SELECT 'notes/brand-new', md5('another body')""")
def op_put_page(spark: SparkSession, folder: str) -> DataFrame:
    """One page changed and one made."""
    store = Store(spark, folder).run("put_page", title="Capture log", body="new body", **LOG).run("put_page", slug="notes/brand-new", title="New", body="another body")
    return store["pages"].select("slug", F.md5(F.coalesce("compiled_truth", F.lit(""))).alias("body"))


@query(f"SELECT count(DISTINCT id) AS pages FROM pages WHERE deleted_at IS NULL AND NOT {_LOG}")
def op_delete_page(spark: SparkSession, folder: str) -> DataFrame:
    store = Store(spark, folder).run("delete_page", **LOG)
    return store["pages"].where("deleted_at IS NULL").agg(F.countDistinct("id").alias("pages"))


@query("SELECT count(DISTINCT id) AS pages FROM pages WHERE deleted_at IS NULL")
def op_restore_page(spark: SparkSession, folder: str) -> DataFrame:
    """A page deleted and restored; others stay as they are."""
    store = Store(spark, folder).run("delete_page", **LOG).run("restore_page", **LOG)
    return store["pages"].where("deleted_at IS NULL").agg(F.countDistinct("id").alias("pages"))


@query("""WITH g AS (SELECT DISTINCT id FROM pages WHERE deleted_at < TIMESTAMP '2025-09-01') SELECT (SELECT count(DISTINCT id) FROM pages WHERE id NOT IN (SELECT id FROM g)) AS pages, (SELECT count(DISTINCT id) FROM content_chunks WHERE page_id IS NULL OR page_id NOT IN (SELECT id FROM g)) AS chunks, (SELECT count(DISTINCT id) FROM links WHERE from_page_id NOT IN (SELECT id FROM g) AND to_page_id NOT IN (SELECT id FROM g)) AS links""")
def op_purge_deleted_pages(spark: SparkSession, folder: str) -> DataFrame:
    store = Store(spark, folder).run("purge_deleted_pages", before="2025-09-01")
    one = lambda name, out: store[name].agg(F.countDistinct("id").alias(out))
    return one("pages", "pages").crossJoin(one("content_chunks", "chunks")).crossJoin(one("links", "links"))  # one row each


@query(f"""SELECT id, slug FROM (SELECT DISTINCT id, slug, updated_at FROM pages WHERE deleted_at IS NULL AND type = 'note' AND source_id IN ('default', 'capture-inbox') AND id IN (SELECT page_id FROM {_TAGS} WHERE tag = (SELECT tag FROM {_TAGS} GROUP BY 1 ORDER BY count(*) DESC, tag LIMIT 1))) ORDER BY updated_at DESC NULLS LAST, id LIMIT 20""")
def op_list_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Notes of two sources with the commonest tag."""
    store = Store(spark, folder)
    top = store["tags"].groupBy("tag").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "tag").first()  # one row
    return store.run("list_pages", types=["note"], tag=top["tag"] if top else "", sources=["default", "capture-inbox"]).select("id", "slug")


@query(f"SELECT name, id, CASE WHEN id IS NULL THEN 'none' ELSE 'slug' END AS how FROM (SELECT 'inbox/capture-log' AS name, 1 AS id UNION ALL SELECT 'no such thing at all zz', NULL)")
def op_resolve_slugs(spark: SparkSession, folder: str) -> DataFrame:
    return Store(spark, folder).run("resolve_slugs", names=["inbox/capture-log", "no such thing at all zz"])


@query(f"SELECT DISTINCT c.id, chunk_index FROM content_chunks c JOIN pages p ON p.id = c.page_id WHERE p.slug = 'inbox/capture-log' AND p.source_id = 'capture-inbox'")
def op_get_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return Store(spark, folder).run("get_chunks", **LOG).select("id", "chunk_index")


@query(f"SELECT md5(compiled_truth) AS body, TIMESTAMP '2026-01-01' AS snapshot_at FROM (SELECT DISTINCT compiled_truth FROM pages WHERE {_LOG}) UNION ALL SELECT md5('second'), TIMESTAMP '2026-02-01'")
def op_get_versions(spark: SparkSession, folder: str) -> DataFrame:
    """The versions that two changes leave."""
    store = Store(spark, folder).run("put_page", title="t", body="second", **LOG).run("put_page", title="t", body="third", now="2026-02-01 00:00:00", **LOG)
    return store.run("get_versions", **LOG).select(F.md5("compiled_truth").alias("body"), "snapshot_at")


@query(f"SELECT DISTINCT md5(compiled_truth) AS body, CAST(2 AS BIGINT) AS versions FROM pages WHERE {_LOG}")
def op_revert_version(spark: SparkSession, folder: str) -> DataFrame:
    store = Store(spark, folder).run("put_page", title="t", body="second", **LOG).run("revert_version", snapshot_at=NOW, now="2026-02-01 00:00:00", **LOG)
    return store.run("get_page", **LOG).select(F.md5("compiled_truth").alias("body")).crossJoin(store["page_versions"].agg(F.count("*").alias("versions")))  # one row each


@query("SELECT 1 AS page_id, 'feed' AS source, 'b' AS value UNION ALL SELECT 1, 'mail', 'a'")
def op_raw_data(spark: SparkSession, folder: str) -> DataFrame:
    """Raw data by page and source: the second write of a source replaces the first."""
    store = Store(spark, folder)
    for source, data in (("feed", '{"v": "a"}'), ("mail", '{"v": "a"}'), ("feed", '{"v": "b"}')):
        store = store.run("put_raw_data", source=source, data=data, **LOG)
    return store.run("get_raw_data", **LOG).select("page_id", "source", F.get_json_object("data", "$.v").alias("value"))


@query("SELECT 'first' AS tag UNION ALL SELECT 'third'")
def op_tags(spark: SparkSession, folder: str) -> DataFrame:
    """Tags added, one of them twice, and one removed."""
    store = Store(spark, folder)
    for tag in ("third", "second", "first", "first"):
        store = store.run("add_tag", tag=tag, **LOG)
    return store.run("remove_tag", tag="second", **LOG).run("get_tags", **LOG)


@query(f"""WITH h AS {_HUBS} SELECT DISTINCT p.slug, l.link_type, l.link_source FROM links l JOIN h ON h.id = l.from_page_id JOIN pages p ON p.id = l.to_page_id""")
def op_get_links(spark: SparkSession, folder: str) -> DataFrame:
    store = Store(spark, folder)
    return store.run("get_links", **_hub(store, "from_page_id")).select("slug", "link_type", "link_source").distinct()


@query(f"""WITH h AS {_HUB} SELECT DISTINCT p.slug, l.link_type, l.link_source FROM links l JOIN h ON h.id = l.to_page_id JOIN pages p ON p.id = l.from_page_id""")
def op_get_backlinks(spark: SparkSession, folder: str) -> DataFrame:
    store = Store(spark, folder)
    return store.run("get_backlinks", **_hub(store, "to_page_id")).select("slug", "link_type", "link_source").distinct()


@query(f"""WITH h AS {_HUB} SELECT DISTINCT from_page_id AS src, link_type FROM links, h WHERE to_page_id = h.id UNION SELECT 1, 'cites'""")
def op_add_link(spark: SparkSession, folder: str) -> DataFrame:
    """An edge added twice counts once."""
    store = Store(spark, folder)
    hub = _hub(store, "to_page_id")
    for _ in range(2):
        store = store.run("add_link", src=LOG["slug"], dst=LOG["slug"], link_type="cites", source_id=LOG["source_id"])
    ids = store["pages"].where((F.col("slug") == hub["slug"]) & (F.col("source_id") == hub["source_id"])).select(F.col("id").alias("to_page_id"))
    rows = store["links"].join(ids.union(spark.range(1).select(F.lit(1).alias("to_page_id"))).distinct(), "to_page_id", "left_semi").where("to_page_id <> 1 OR link_type = 'cites'")
    return rows.select(F.col("from_page_id").alias("src"), "link_type").distinct()


@query("SELECT CAST(0 AS BIGINT) AS edges")
def op_remove_link(spark: SparkSession, folder: str) -> DataFrame:
    store = Store(spark, folder)
    log = LOG["slug"]
    store = store.run("add_link", src=log, dst=log, link_type="cites", source_id=LOG["source_id"]).run("remove_link", src=log, dst=log, link_type="cites", source_id=LOG["source_id"])
    return store["links"].where("link_type = 'cites' AND from_page_id = 1 AND to_page_id = 1").agg(F.count("*").alias("edges"))


@query(f"SELECT link_source, count(*) AS links FROM {_E} GROUP BY 1")
def op_list_link_sources(spark: SparkSession, folder: str) -> DataFrame:
    return Store(spark, folder).run("list_link_sources")


@query(f"""WITH RECURSIVE h AS {_HUBS}, b AS (SELECT src, dst FROM {_E} UNION SELECT dst, src FROM {_E}), w AS (SELECT id AS node, 0 AS depth, [id] AS path FROM h UNION ALL SELECT b.dst, w.depth + 1, list_append(w.path, b.dst) FROM w JOIN b ON b.src = w.node WHERE w.depth < 2 AND NOT list_contains(w.path, b.dst)) SELECT node, depth, count(*) AS paths FROM w GROUP BY ALL""")
def op_traverse_graph(spark: SparkSession, folder: str) -> DataFrame:
    """Both ways from a page, two links far."""
    store = Store(spark, folder)
    return store.run("traverse_graph", depth=2, way="both", **_hub(store, "from_page_id")).groupBy("node", "depth").agg(F.count("*").alias("paths"))


@query("SELECT DATE '2025-02-03' AS day, 'mail' AS source, 'it began' AS summary")
def op_timeline(spark: SparkSession, folder: str) -> DataFrame:
    """An entry added twice, read back in a range of days."""
    store = Store(spark, folder)
    for _ in range(2):
        store = store.run("add_timeline_entry", date="2025-02-03", summary="it began", source="mail", **LOG)
    rows = store.run("get_timeline", since="2025-02-03", until="2025-02-03", **LOG).where("summary = 'it began'")
    return rows.select(F.col("date").alias("day"), "source", "summary")


@query(f"SELECT page_id, rank FROM {_KARM} WHERE rank < 20")
def op_search(spark: SparkSession, folder: str) -> DataFrame:
    return Store(spark, folder).run("search", text=ASKED).select("page_id", "rank")


@query(f"SELECT page_id, round(score, 6) AS score FROM (SELECT page_id, CASE WHEN truth THEN 2.0 ELSE 1.0 END / (60.0 + rank) * 60 AS score FROM {_KARM}) ORDER BY score DESC, page_id LIMIT 20")
def op_query(spark: SparkSession, folder: str) -> DataFrame:
    """Without a query vector the keyword arm alone is fused."""
    return Store(spark, folder).run("query", text=ASKED).select("page_id", F.round("score", 6).alias("score"))


@query(f"SELECT id, strftime(since_date, '%Y-%m') AS since FROM {_C} WHERE holder = 'holder-2' AND active AND quality IS NOT NULL ORDER BY since_date DESC NULLS LAST, id LIMIT 100")
def op_takes_list(spark: SparkSession, folder: str) -> DataFrame:
    return Store(spark, folder).run("takes_list", holder="holder-2", active=True, resolved=True).select("id", "since")


@query(f"SELECT domain, count(*) AS claims, round(count(*) FILTER (quality = 'correct') / nullif(count(*) FILTER (quality IN ('correct', 'incorrect')), 0), 6) AS accuracy FROM {_C} GROUP BY 1")
def op_takes_scorecard(spark: SparkSession, folder: str) -> DataFrame:
    return Store(spark, folder).run("takes_scorecard", by=["domain"]).select("domain", "claims", F.round("accuracy", 6).alias("accuracy"))


@query(f"SELECT CAST(least(floor(weight * 5), 4) AS INT) AS bucket, count(*) AS n, round(avg(weight), 6) AS predicted, round(avg(CASE quality WHEN 'correct' THEN 1.0 ELSE 0.0 END), 6) AS observed FROM {_C} WHERE quality IN ('correct', 'incorrect') GROUP BY 1")
def op_takes_calibration(spark: SparkSession, folder: str) -> DataFrame:
    return Store(spark, folder).run("takes_calibration", step=5).select("bucket", "n", F.round("predicted", 6).alias("predicted"), F.round("observed", 6).alias("observed"))


@query(f"SELECT id FROM {_FA} WHERE expired_at IS NULL AND session = 'session-7' AND valid_from >= DATE '2024-01-01' ORDER BY valid_from DESC, id LIMIT 50")
def op_recall(spark: SparkSession, folder: str) -> DataFrame:
    return Store(spark, folder).run("recall", session="session-7", since="2024-01-01").select("id")


@query(f"SELECT count(*) FILTER (expired_at IS NULL AND id <> (SELECT min(id) FROM {_FA})) AS live FROM {_FA}")
def op_forget_fact(spark: SparkSession, folder: str) -> DataFrame:
    store = Store(spark, folder)
    first = store["facts"].agg(F.min("id").alias("id")).first()["id"]  # one row
    return store.run("forget_fact", fact_id=first).run("forget_fact", fact_id=first)["facts"].agg(F.count_if(F.col("expired_at").isNull()).alias("live"))


@query(f"SELECT metric, valid_from AS day, amount FROM {_FA} WHERE metric IS NOT NULL AND entity_id = (SELECT entity_id FROM {_FA} WHERE metric IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, entity_id LIMIT 1)")
def op_find_trajectory(spark: SparkSession, folder: str) -> DataFrame:
    store = Store(spark, folder)
    top = store["facts"].where("metric IS NOT NULL").groupBy("entity_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "entity_id").first()  # one row
    return store.run("find_trajectory", entity_id=top["entity_id"]).select("metric", F.col("valid_from").alias("day"), "amount")


@query(f"WITH r AS (SELECT id, page_id, weight, since_date FROM {_C} WHERE active AND id % 3 = 0) SELECT a.id AS a, b.id AS b FROM r a JOIN r b ON a.page_id = b.page_id AND a.id < b.id AND (a.weight - 0.5) * (b.weight - 0.5) < 0 AND abs(date_diff('day', a.since_date, b.since_date)) <= 30")
def op_find_contradictions(spark: SparkSession, folder: str) -> DataFrame:
    return Store(spark, folder).run("find_contradictions", every=3)


@query(f"""SELECT 'pages' AS kind, count(DISTINCT id) AS n FROM pages WHERE deleted_at IS NULL UNION ALL SELECT 'chunks', count(DISTINCT id) FROM content_chunks UNION ALL SELECT 'links', count(*) FROM {_E} UNION ALL SELECT 'tags', count(DISTINCT tag) FROM {_TAGS}
UNION ALL SELECT 'entries', count(*) FROM (SELECT DISTINCT page_id, date, source, summary FROM timeline_entries) UNION ALL SELECT 'type ' || coalesce(type, 'none'), count(DISTINCT id) FROM pages GROUP BY 1""")
def op_get_stats(spark: SparkSession, folder: str) -> DataFrame:
    return Store(spark, folder).run("get_stats")


@query(f"""SELECT p.id, round(coalesce(CAST(emotional_weight AS DOUBLE), 0) * 5 + ln(1 + coalesce(n, 0)), 6) AS salience FROM (SELECT DISTINCT id, emotional_weight FROM pages WHERE deleted_at IS NULL) p LEFT JOIN (SELECT page_id, count(DISTINCT row_num) AS n FROM {_C} GROUP BY 1) c ON c.page_id = p.id ORDER BY coalesce(CAST(emotional_weight AS DOUBLE), 0) * 5 + ln(1 + coalesce(n, 0)) DESC, p.id LIMIT 20""")
def op_get_recent_salience(spark: SparkSession, folder: str) -> DataFrame:
    return Store(spark, folder).run("get_recent_salience").select("id", F.round("salience", 6).alias("salience"))


@query(f"""WITH c AS (SELECT coalesce(source, 'none') AS cohort, date AS day, count(*) AS n FROM (SELECT DISTINCT page_id, date, source, summary FROM timeline_entries WHERE date BETWEEN DATE '2025-01-01' AND DATE '2025-06-30') GROUP BY ALL), s AS (SELECT min(day) AS a, max(day) AS z FROM c),
g AS (SELECT k.cohort, d.day, coalesce(c.n, 0) AS n FROM (SELECT DISTINCT cohort FROM c) k CROSS JOIN (SELECT CAST(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS day FROM s) d LEFT JOIN c ON c.cohort = k.cohort AND c.day = d.day),
t AS (SELECT cohort, count(*) - 1 AS m, sum(n) AS t, sum(n * n) AS q FROM g GROUP BY 1), o AS (SELECT g.*, (t - n) / m AS mean, sqrt(greatest((q - n * n - m * power((t - n) / m, 2)) / (m - 1), 0)) AS spread FROM g JOIN t USING (cohort) WHERE m > 1)
SELECT cohort, day, n FROM o WHERE CASE WHEN spread < 1e-9 THEN n > mean + 1 ELSE n > mean + 3 * spread END""")
def op_find_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    return Store(spark, folder).run("find_anomalies", since="2025-01-01", until="2025-06-30").select("cohort", "day", "n")


@query("SELECT id, name FROM sources WHERE NOT coalesce(archived, false) AND id <> 'default' UNION ALL SELECT 'extra', 'Extra'")
def op_sources(spark: SparkSession, folder: str) -> DataFrame:
    """One source added, one archived, the rest listed."""
    store = Store(spark, folder).run("sources_add", id="extra", name="Extra").run("sources_add", id="extra", name="Other").run("sources_remove", id="default")
    return store.run("sources_list").select("id", "name")


@query("SELECT s.id, count(p.id) AS pages, max(p.updated_at) AS newest FROM sources s LEFT JOIN (SELECT DISTINCT id, source_id, updated_at FROM pages WHERE deleted_at IS NULL) p ON p.source_id = s.id GROUP BY 1")
def op_sources_status(spark: SparkSession, folder: str) -> DataFrame:
    return Store(spark, folder).run("sources_status")


@query("SELECT CAST(2 AS BIGINT) AS id, 'b' AS summary UNION ALL SELECT 1, 'a'")
def op_ingest_log(spark: SparkSession, folder: str) -> DataFrame:
    store = Store(spark, folder).run("log_ingest", source_id="default", summary="a").run("log_ingest", source_id="default", summary="b", now="2026-01-02 00:00:00")
    return store.run("get_ingest_log").select("id", "summary")


@query(f"SELECT storage_path FROM {_FI} ORDER BY storage_path LIMIT 100")
def op_file_list(spark: SparkSession, folder: str) -> DataFrame:
    return Store(spark, folder).run("file_list").select("storage_path")


_LJ = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC NULLS LAST, status DESC) AS n FROM {_J}) WHERE n = 1)"


@query(f"SELECT id, status FROM {_LJ} WHERE id = (SELECT min(id) FROM minion_jobs)")
def op_get_job(spark: SparkSession, folder: str) -> DataFrame:
    store = Store(spark, folder)
    return store.run("get_job", job_id=store["minion_jobs"].agg(F.min("id").alias("id")).first()["id"]).select("id", "status")


@query(f"SELECT id, name FROM {_LJ} WHERE status = 'failed' ORDER BY created_at DESC NULLS LAST, id LIMIT 30")
def op_list_jobs(spark: SparkSession, folder: str) -> DataFrame:
    return Store(spark, folder).run("list_jobs", status="failed", limit=30).select("id", "name")


_TOP = f"(SELECT callee FROM {_CALLS} JOIN (SELECT DISTINCT symbol_name AS callee FROM content_chunks WHERE symbol_name IS NOT NULL) USING (callee) GROUP BY 1 ORDER BY count(*) DESC, callee LIMIT 1)"
_DEF = "(SELECT symbol_name AS callee, min(id) AS dst FROM content_chunks WHERE symbol_name IS NOT NULL GROUP BY 1)"
_CE = f"(SELECT DISTINCT c.chunk_id AS src, c.callee, d.dst FROM {_CALLS} c LEFT JOIN {_DEF} d USING (callee))"


def _symbol(store: Store) -> str:
    """The symbol most called of those that are defined: one row."""
    from ..api import _calls

    row = _calls(store).where("dst IS NOT NULL").groupBy("callee").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "callee").first()
    return row["callee"] if row else ""


@query(f"SELECT DISTINCT id, symbol_type FROM content_chunks WHERE symbol_name = {_TOP} OR symbol_name_qualified = {_TOP}")
def op_code_def(spark: SparkSession, folder: str) -> DataFrame:
    store = Store(spark, folder)
    return store.run("code_def", symbol=_symbol(store)).select("id", "symbol_type")


@query(f"SELECT DISTINCT id, language FROM content_chunks WHERE language IS NOT NULL AND contains(chunk_text, {_TOP})")
def op_code_refs(spark: SparkSession, folder: str) -> DataFrame:
    store = Store(spark, folder)
    return store.run("code_refs", symbol=_symbol(store)).select("id", "language")


@query(f"SELECT DISTINCT src AS id FROM {_CE} WHERE callee = {_TOP} AND src IS DISTINCT FROM dst")
def op_code_callers(spark: SparkSession, folder: str) -> DataFrame:
    store = Store(spark, folder)
    return store.run("code_callers", symbol=_symbol(store)).select("id")


@query(f"SELECT DISTINCT callee, dst AS id FROM {_CE} WHERE callee <> {_TOP} AND src IN (SELECT id FROM content_chunks WHERE symbol_name = {_TOP} OR symbol_name_qualified = {_TOP})")
def op_code_callees(spark: SparkSession, folder: str) -> DataFrame:
    store = Store(spark, folder)
    return store.run("code_callees", symbol=_symbol(store))


def _walk_sql(src: str, dst: str, depth: int) -> str:
    return f"""WITH RECURSIVE e AS (SELECT DISTINCT src, dst FROM {_CE} WHERE dst IS NOT NULL AND src <> dst), w AS (SELECT DISTINCT id, 0 AS depth FROM content_chunks WHERE symbol_name = {_TOP} OR symbol_name_qualified = {_TOP} UNION SELECT e.{dst}, w.depth + 1 FROM w JOIN e ON e.{src} = w.id WHERE w.depth < {depth}) SELECT id, min(depth) AS depth FROM w GROUP BY 1"""


@query(_walk_sql("dst", "src", 5))
def op_code_blast(spark: SparkSession, folder: str) -> DataFrame:
    store = Store(spark, folder)
    return store.run("code_blast", symbol=_symbol(store)).select("id", "depth")


@query(_walk_sql("src", "dst", 8))
def op_code_flow(spark: SparkSession, folder: str) -> DataFrame:
    store = Store(spark, folder)
    return store.run("code_flow", symbol=_symbol(store)).select("id", "depth")


@query("SELECT source_id, count(*) AS pages, count(type) AS typed, count(DISTINCT type) AS types FROM (SELECT DISTINCT id, source_id, type FROM pages WHERE deleted_at IS NULL) GROUP BY 1")
def op_schema_stats(spark: SparkSession, folder: str) -> DataFrame:
    return Store(spark, folder).run("schema_stats")


@query(f"SELECT a.type AS from_type, e.link_type, b.type AS to_type, count(*) AS n FROM {_E} e JOIN (SELECT DISTINCT id, type FROM pages) a ON a.id = e.src JOIN (SELECT DISTINCT id, type FROM pages) b ON b.id = e.dst GROUP BY ALL")
def op_schema_graph(spark: SparkSession, folder: str) -> DataFrame:
    return Store(spark, folder).run("schema_graph")


@query("SELECT split_part(slug, '/', 1) AS prefix, count(DISTINCT id) AS pages FROM pages WHERE type = 'person' GROUP BY 1")
def op_schema_explain_type(spark: SparkSession, folder: str) -> DataFrame:
    return Store(spark, folder).run("schema_explain_type", kind="person")


@query("WITH p AS (SELECT DISTINCT id, slug, type, split_part(slug, '/', 1) AS prefix FROM pages WHERE deleted_at IS NULL) SELECT id, type FROM p WHERE (prefix, type) IN (SELECT (prefix, type) FROM p GROUP BY prefix, type HAVING count(*) = 1) ORDER BY id LIMIT 100")
def op_schema_review_orphans(spark: SparkSession, folder: str) -> DataFrame:
    return Store(spark, folder).run("schema_review_orphans").select("id", "type")


@query("SELECT id, fault FROM (SELECT DISTINCT id, CASE WHEN type IS NULL THEN 'no type' WHEN coalesce(title, '') = '' THEN 'no title' WHEN NOT regexp_matches(slug, '^[a-z0-9._/-]+$') THEN 'slug' END AS fault FROM pages WHERE deleted_at IS NULL) WHERE fault IS NOT NULL")
def op_schema_lint(spark: SparkSession, folder: str) -> DataFrame:
    return Store(spark, folder).run("schema_lint")


@query("SELECT lang, count(*) AS n FROM documents WHERE kind = 'chat' GROUP BY 1")
def op_raw_sql(spark: SparkSession, folder: str) -> DataFrame:
    """A statement with a named parameter over a table of the store."""
    return Store(spark, folder).run("raw_sql", statement="SELECT lang, count(*) AS n FROM {documents} WHERE kind = :kind GROUP BY lang", tables=["documents"], args={"kind": "chat"})
