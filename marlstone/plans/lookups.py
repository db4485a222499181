"""Queries over lookups, gates, packs and smaller operators, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import extensions, packs
from ..functions import scores, strings
from ..operators import graph, measures, search, vectors, writes
from ..sources import files
from ..sources.tables import table
from .derived import derived, sql
from .knowledge import _C, _E, _P, _LIVE, NOW, _chunks, _live, _pages
from .registry import query
from .writes import _TAGS, tag_rows

_CL, _FA, _FI, _CAP = sql("claims"), sql("facts"), sql("files"), sql("captured")
# Signs of pages that hold a fetch error rather than a text: of the title, and of the head of the body.
JUNK_TITLE = r"(?i)^(403|404|500|502|503|error \d{3}|page not found|forbidden|access denied|service unavailable|robot check|verify you are human|just a moment\.{0,3})\s*$"
JUNK_HEAD = r"(?i)(attention required.*cloudflare|cloudflare ray id:|checking your browser before|cf[-_]browser[-_]verification|enable javascript and cookies to continue|verify you are (a )?human|captcha required|please complete the security check)"


# --- lookups ----------------------------------------------------------------------------------------


@query(f"SELECT w.path, min(f.page_slug) AS slug FROM (SELECT DISTINCT storage_path AS path FROM {_FI} WHERE page_id % 10 = 0 UNION SELECT 'no/such/path') w LEFT JOIN {_FI} f ON f.storage_path = w.path GROUP BY 1")
def slugs_of_paths(spark: SparkSession, folder: str) -> DataFrame:
    """The page of each path asked for."""
    stored = derived(spark, folder, "files")
    asked = stored.where("page_id % 10 = 0").select(F.col("storage_path").alias("path")).union(spark.range(1).select(F.lit("no/such/path"))).distinct()
    return asked.join(stored.select(F.col("storage_path").alias("path"), "page_slug"), "path", "left").groupBy("path").agg(F.min("page_slug").alias("slug"))


@query("SELECT DISTINCT id, len(embedding) AS dims, round(CAST(embedding[1] AS DOUBLE), 6) AS first FROM content_chunks WHERE id % 50 = 0 AND embedding IS NOT NULL AND NOT isnan(embedding[1]) AND NOT isinf(embedding[1])")
def fetched_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The vectors of a stated set of chunks; the filter runs on the scan."""
    rows = table(spark, folder, "content_chunks").where("id % 50 = 0 AND size(embedding) > 0 AND NOT isnan(embedding[0]) AND abs(embedding[0]) <> float('inf')")
    return rows.select("id", F.size("embedding").cast("bigint").alias("dims"), F.round(F.col("embedding")[0].cast("double"), 6).alias("first")).distinct()


@query(f"""SELECT page_id, id FROM (SELECT DISTINCT page_id, chunk_index, id FROM content_chunks WHERE embedding IS NULL AND (page_id, chunk_index) > (1100, 0)) ORDER BY page_id, chunk_index LIMIT 100""")
def unembedded_page(spark: SparkSession, folder: str) -> DataFrame:
    """The next hundred chunks without a vector behind a key: keyset pagination."""
    rows = table(spark, folder, "content_chunks").where("embedding IS NULL").select("page_id", "chunk_index", "id").distinct()
    behind = (F.col("page_id") > 1100) | ((F.col("page_id") == 1100) & (F.col("chunk_index") > 0))
    return rows.where(behind).orderBy("page_id", "chunk_index").limit(100).select("page_id", "id")


@query(f"SELECT storage_path, count(*) AS pages FROM {_FI} WHERE source_id = 'default' GROUP BY 1")
def files_by_path(spark: SparkSession, folder: str) -> DataFrame:
    return derived(spark, folder, "files").where("source_id = 'default'").groupBy("storage_path").agg(F.count("*").alias("pages"))


@query("SELECT id AS key, name AS value FROM sources WHERE starts_with(id, 'd')")
def config_prefix(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "sources").where("id LIKE 'd%'").select(F.col("id").alias("key"), F.col("name").alias("value"))


@query(f"SELECT id, created_at FROM {_CAP} WHERE tool = 'error' AND created_at >= TIMESTAMP '2024-01-20'")
def capture_failures(spark: SparkSession, folder: str) -> DataFrame:
    return derived(spark, folder, "captured").where("tool = 'error' AND created_at >= TIMESTAMP_NTZ '2024-01-20'").select("id", "created_at")


@query(f"SELECT storage_path AS path, CASE WHEN contains('/' || storage_path, '/node_modules/') THEN 'in node_modules' WHEN contains('/' || storage_path, '/.git/') THEN 'in .git' WHEN contains('/' || storage_path, '/dist/') THEN 'in dist' WHEN contains('/' || storage_path, '/build/') THEN 'in build' WHEN contains('/' || storage_path, '/.obsidian/') THEN 'in .obsidian' WHEN NOT regexp_matches(storage_path, '\\.(md|mdx|markdown)$') THEN 'no markdown' END AS reason FROM (SELECT DISTINCT storage_path FROM {_FI})")
def path_exclusions(spark: SparkSession, folder: str) -> DataFrame:
    """Why each path is no document to import."""
    return derived(spark, folder, "files").select(F.col("storage_path").alias("path")).distinct().withColumn("reason", files.exclusion(F.col("path")))


@query("SELECT doc_id, title, created_at FROM documents WHERE kind IN ('chat', 'meeting') ORDER BY created_at DESC NULLS LAST, doc_id LIMIT 40")
def recent_transcripts(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").where("kind IN ('chat', 'meeting')")
    return rows.orderBy(F.desc_nulls_last("created_at"), "doc_id").limit(40).select("doc_id", "title", "created_at")


@query("SELECT source, count(*) AS messages, count(DISTINCT doc_id) AS sessions, min(created_at) AS first_at FROM documents WHERE kind = 'chat' GROUP BY 1")
def chat_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """Chats as pages of their sources."""
    rows = table(spark, folder, "documents").where("kind = 'chat'")
    return rows.groupBy("source").agg(F.count("*").alias("messages"), F.countDistinct("doc_id").alias("sessions"), F.min("created_at").alias("first_at"))


@query(f"""WITH p AS (SELECT p.slug, p.id, p.source_id, row_number() OVER (PARTITION BY p.slug ORDER BY p.source_id <> 'default', p.source_id, p.id) AS n FROM (SELECT DISTINCT slug, id, source_id FROM pages) p JOIN sources s ON s.id = p.source_id WHERE p.source_id = 'default' OR json_extract_string(s.config, '$.federated') = 'true') SELECT slug, id FROM p WHERE n = 1""")
def federated_profiles(spark: SparkSession, folder: str) -> DataFrame:
    """The page of each slug: the local one, else the first of the sources that share theirs."""
    shared = table(spark, folder, "sources").where(F.get_json_object("config", "$.federated") == "true").select(F.col("id").alias("source_id"), F.lit(True).alias("shared"))
    rows = _pages(spark, folder, "slug", "source_id").join(shared, "source_id", "left").where("source_id = 'default' OR shared")
    best = F.min(F.struct((F.col("source_id") != "default").alias("far"), "source_id", "id")).alias("b")
    return rows.groupBy("slug").agg(best).select("slug", "b.id")


# --- gates and filters ------------------------------------------------------------------------------


@query(f"""SELECT DISTINCT id, octet_length(encode(coalesce(compiled_truth, ''))) > 500000 AS oversized, regexp_matches(trim(coalesce(title, '')), '{JUNK_TITLE}') OR regexp_matches(left(coalesce(compiled_truth, ''), 2048), '{JUNK_HEAD}') AS junk FROM pages""")
def content_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Pages too large or that hold the signs of a failed fetch; whole bodies are measured, their heads tested."""
    body = F.coalesce("compiled_truth", F.lit(""))
    junk = F.trim(F.coalesce("title", F.lit(""))).rlike(JUNK_TITLE) | F.substring(body, 1, 2048).rlike(JUNK_HEAD)
    return table(spark, folder, "pages").select("id", (F.octet_length(body) > 500_000).alias("oversized"), junk.alias("junk")).distinct()


@query(f"""SELECT DISTINCT id FROM pages WHERE type IN ('note', 'meeting') AND deleted_at IS NULL AND length(compiled_truth) >= 300 AND json_extract(frontmatter, '$.tags') IS NOT NULL AND created_at <= TIMESTAMP '{NOW}' - INTERVAL 30 DAY""")
def eligible_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of some types, long and old enough, with a key in their front matter."""
    rows = table(spark, folder, "pages").where("type IN ('note', 'meeting') AND deleted_at IS NULL AND length(compiled_truth) >= 300")
    old = F.col("created_at") <= F.to_timestamp_ntz(F.lit(NOW)) - F.expr("INTERVAL 30 DAY")
    return rows.where(F.get_json_object("frontmatter", "$.tags").isNotNull() & old).select("id").distinct()


@query(f"""SELECT id FROM {_CL} c WHERE id % 2 = 0 AND NOT EXISTS (SELECT 1 FROM {_CL} d WHERE d.page_id = c.page_id AND d.id % 2 = 1 AND d.since_date BETWEEN c.since_date - 14 AND c.since_date)""")
def cooled_down(spark: SparkSession, folder: str) -> DataFrame:
    """Claims without another of the page in the fourteen days before: an anti-join with a range inside the key."""
    rows = derived(spark, folder, "claims").select("id", "page_id", "since_date")
    recent = rows.where("id % 2 = 1").select("page_id", F.col("since_date").alias("d"))
    one = rows.where("id % 2 = 0")
    match = (one["page_id"] == recent["page_id"]) & (F.date_diff(one["since_date"], recent["d"]).between(0, 14))
    return one.join(recent, match, "left_anti").select("id")


@query("SELECT DISTINCT id FROM pages WHERE deleted_at IS NULL AND NOT regexp_matches(slug, '(^|/)(index|readme|_[^/]*)$') AND NOT starts_with(slug, 'inbox/')")
def orphan_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Pages that may count as orphans by the shape of their slug."""
    rows = table(spark, folder, "pages").where("deleted_at IS NULL AND NOT slug LIKE 'inbox/%'")
    return rows.where(~F.col("slug").rlike("(^|/)(index|readme|_[^/]*)$")).select("id").distinct()


_RUN = "' ' || array_to_string(regexp_extract_all(lower({}), '([\\p{{L}}\\p{{N}}]+)', 1), ' ') || ' '"


@query(f"""SELECT c.id, min(t.tag) AS hint FROM {_CL} c LEFT JOIN (SELECT DISTINCT tag FROM {_TAGS} WHERE len(regexp_extract_all(lower(tag), '([\\p{{L}}\\p{{N}}]+)', 1)) BETWEEN 1 AND 4) t ON contains({_RUN.format('c.claim')}, {_RUN.format('t.tag')}) WHERE c.weight > 0.7 AND c.active GROUP BY 1""")
def hinted_claims(spark: SparkSession, folder: str) -> DataFrame:
    """The first tag whose words stand in each weighty claim: a dictionary join on runs of up to four words."""
    words = lambda c: F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}]+)"), 1)
    tags = tag_rows(spark, folder).select("tag", words(F.col("tag")).alias("w")).where("size(w) BETWEEN 1 AND 4").groupBy(F.array_join("w", " ").alias("run")).agg(F.min("tag").alias("tag"))
    rows = derived(spark, folder, "claims").where("weight > 0.7 AND active").select("id", words(F.col("claim")).alias("w"))
    runs = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda n: F.transform(F.filter(F.sequence(F.lit(1), F.greatest(F.size("w"), F.lit(1))), lambda i: i + n - 1 <= F.size("w")), lambda i: F.array_join(F.slice("w", i, n), " "))))
    met = rows.select("id", F.explode(F.array_distinct(runs)).alias("run")).join(tags, "run").groupBy("id").agg(F.min("tag").alias("hint"))
    return rows.select("id").join(met, "id", "left")


@query("""SELECT a.id FROM (SELECT DISTINCT id, substring(coalesce(content_hash, ''), 1, 16) AS k FROM pages) a WHERE NOT EXISTS (SELECT 1 FROM pages b WHERE b.id % 3 = 0 AND substring(coalesce(b.content_hash, ''), 1, 16) = a.k)""")
def unseen_hashes(spark: SparkSession, folder: str) -> DataFrame:
    """Pages whose shortened hash no page of a set has: an anti-join on a computed key."""
    rows = _pages(spark, folder, F.substring(F.coalesce("content_hash", F.lit("")), 1, 16).alias("k"))
    return rows.join(rows.where("id % 3 = 0").select("k"), "k", "left_anti").select("id")


@query("""SELECT s.id, count(p.id) AS notes FROM sources s LEFT JOIN (SELECT DISTINCT id, source_id, type FROM pages) p ON p.source_id = s.id AND p.type IN ('note', 'meeting') GROUP BY 1""")
def scoped_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Every source with its notes: the list of types belongs to the join, not to a filter behind it."""
    n = _pages(spark, folder, "source_id", "type").where("type IN ('note', 'meeting')").groupBy(F.col("source_id").alias("id")).agg(F.count("*").alias("notes"))
    return table(spark, folder, "sources").select("id").join(n, "id", "left").select("id", F.coalesce("notes", F.lit(0)).cast("bigint").alias("notes"))


@query("SELECT p.id, u.at FROM (SELECT DISTINCT id, slug, source_id FROM pages) p JOIN (SELECT unnest(['inbox/capture-log', 'no/page']) AS slug, unnest(['capture-inbox', 'default']) AS source_id, unnest([DATE '2025-01-01', DATE '2025-01-02']) AS at) u USING (slug, source_id)")
def joined_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """Pages met by parallel arrays, zipped and exploded."""
    arrays = spark.range(1).select(F.array(F.lit("inbox/capture-log"), F.lit("no/page")).alias("slug"), F.array(F.lit("capture-inbox"), F.lit("default")).alias("source_id"), F.array(F.to_date(F.lit("2025-01-01")), F.to_date(F.lit("2025-01-02"))).alias("at"))
    rows = arrays.select(F.explode(F.arrays_zip("slug", "source_id", "at")).alias("z")).select("z.*")
    return _pages(spark, folder, "slug", "source_id").join(rows, ["slug", "source_id"]).select("id", "at")


@query(f"SELECT c.domain, p.type, count(*) AS claims, round(avg(c.weight), 6) AS mean FROM {_CL} c JOIN (SELECT DISTINCT id, type FROM pages) p ON p.id = c.page_id GROUP BY ALL")
def domain_claims(spark: SparkSession, folder: str) -> DataFrame:
    claims = derived(spark, folder, "claims").join(_pages(spark, folder, "type").withColumnRenamed("id", "page_id"), "page_id")
    return claims.groupBy("domain", "type").agg(F.count("*").alias("claims"), F.round(F.avg("weight"), 6).alias("mean"))


@query(f"WITH h AS (SELECT DISTINCT id, page_id FROM content_chunks WHERE chunk_index = 0) SELECT h.id AS chunk_id, c.row_num, round(c.weight + 1, 6) AS score FROM h JOIN {_CL} c ON c.page_id = h.page_id AND c.active")
def chunks_with_claims(spark: SparkSession, folder: str) -> DataFrame:
    """First chunks beside the open claims of their pages."""
    hits = _chunks(spark, folder, "page_id", "chunk_index").where("chunk_index = 0").select(F.col("id").alias("chunk_id"), "page_id")
    return hits.join(derived(spark, folder, "claims").where("active"), "page_id").select("chunk_id", "row_num", F.round(F.col("weight") + 1, 6).alias("score"))


# --- packs ------------------------------------------------------------------------------------------

_TYPED = "CASE " + " ".join(f"WHEN starts_with(slug, '{p}') THEN '{t.name}'" for t in packs.DEFAULT.types for p in t.prefixes) + " END"


@query(f"SELECT DISTINCT id, {_TYPED} AS declared, {_TYPED} IS DISTINCT FROM type AS off FROM pages")
def declared_types(spark: SparkSession, folder: str) -> DataFrame:
    """The type that a pack declares for each page's prefix, and whether the page has another."""
    kind = packs.DEFAULT.type_of(F.col("slug"))
    return _pages(spark, folder, "slug", "type").select("id", kind.alias("declared"), (~kind.eqNullSafe(F.col("type"))).alias("off"))


@query("SELECT DISTINCT id FROM pages WHERE type = 'memo' OR (type = 'note' AND json_extract_string(frontmatter, '$.kind') = 'memo')")
def aliased_type(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of a type asked for by another of its names."""
    return table(spark, folder, "pages").where(packs.DEFAULT.of_type("memo", F.col("type"), F.col("frontmatter"))).select("id").distinct()


@query(f"SELECT DISTINCT p.source_id, p.type FROM (SELECT DISTINCT source_id, type FROM pages) p JOIN (SELECT unnest(['person', 'company', 'memo']) AS type) c ON c.type = p.type")
def type_closure(spark: SparkSession, folder: str) -> DataFrame:
    """What types of each source some names mean, by the pack's closure."""
    asked = packs.DEFAULT.closure(spark).where("asked IN ('person', 'company', 'memo') AND field IS NULL").select("type").distinct()
    return table(spark, folder, "pages").select("source_id", "type").distinct().join(asked, "type", "left_semi").select("source_id", "type")


@query(f"SELECT id, CASE WHEN regexp_matches(lower(context), '\\bfounded\\b') THEN 'founded' WHEN regexp_matches(lower(context), '\\binvested in\\b') THEN 'invested_in' WHEN regexp_matches(lower(context), '\\b(met|attended|joined)\\b') AND type = 'meeting' THEN 'attended' WHEN regexp_matches(lower(context), '\\badvis') THEN 'advises' END AS told FROM (SELECT DISTINCT l.id, l.context, p.type FROM links l JOIN pages p ON p.id = l.from_page_id)")
def pack_link_types(spark: SparkSession, folder: str) -> DataFrame:
    """The types of links by the pack's rules over their contexts."""
    rows = table(spark, folder, "links").select("id", "context", F.col("from_page_id").alias("page")).distinct().join(_pages(spark, folder, "type").toDF("page", "type"), "page")
    return rows.select("id", packs.DEFAULT.link_type(F.col("context"), F.col("type")).alias("told"))


@query(f"SELECT id, CASE WHEN contains(lower(claim), 'market') THEN 'market' WHEN contains(lower(claim), 'team') THEN 'team' WHEN contains(lower(claim), 'product') THEN 'product' END AS domain FROM {_CL}")
def claim_domains(spark: SparkSession, folder: str) -> DataFrame:
    return derived(spark, folder, "claims").select("id", packs.DEFAULT.domain_of(F.col("claim")).alias("domain"))


# --- projections and smaller aggregates -------------------------------------------------------------


@query("""SELECT id, sha256(concat_ws(chr(31), coalesce(title, ''), coalesce(type, ''), coalesce(compiled_truth, ''), coalesce(timeline, ''))) AS hash FROM (SELECT DISTINCT id, title, type, compiled_truth, timeline FROM pages)""")
def page_hashes(spark: SparkSession, folder: str) -> DataFrame:
    """A hash of each page's content; bodies are hashed on the scan, so only hashes are made distinct."""
    parts = F.concat_ws("\x1f", *[F.coalesce(c, F.lit("")) for c in ("title", "type", "compiled_truth", "timeline")])
    return table(spark, folder, "pages").select("id", F.sha2(parts, 256).alias("hash")).distinct()


@query(f"SELECT id, strftime(since_date, '%Y-%m') AS since, round(weight, 2) AS weight, coalesce(quality, 'open') AS state FROM {_CL}")
def claim_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = derived(spark, folder, "claims")
    return rows.select("id", F.date_format("since_date", "yyyy-MM").alias("since"), F.round("weight", 2).alias("weight"), F.coalesce("quality", F.lit("open")).alias("state"))


@query("""SELECT o_orderpriority AS kind, count(*) AS n, round(sum(try_cast(regexp_replace('$' || printf('%,.2f', o_totalprice), '[$,]', '', 'g') AS DOUBLE)), 1) AS total FROM orders GROUP BY 1""")
def money_sums(spark: SparkSession, folder: str) -> DataFrame:
    """Sums of amounts written as money."""
    shown = F.concat(F.lit("$"), F.format_number("o_totalprice", 2))
    amount = F.expr("try_cast(regexp_replace(shown, '[$,]', '') AS double)")
    rows = table(spark, folder, "orders").select(F.col("o_orderpriority").alias("kind"), shown.alias("shown")).withColumn("amount", amount)
    return rows.groupBy("kind").agg(F.count("*").alias("n"), F.round(F.sum("amount"), 1).alias("total"))


@query(f"SELECT tool, day, n, n - avg_n AS delta FROM (SELECT tool, CAST(created_at AS DATE) AS day, count(*) AS n FROM {_CAP} GROUP BY ALL) JOIN (SELECT tool, CAST(floor(avg(n)) AS BIGINT) AS avg_n FROM (SELECT tool, CAST(created_at AS DATE) AS day, count(*) AS n FROM {_CAP} GROUP BY ALL) GROUP BY 1) USING (tool)")
def baseline_deltas(spark: SparkSession, folder: str) -> DataFrame:
    """Each day of each series against its baseline."""
    days = derived(spark, folder, "captured").groupBy("tool", F.col("created_at").cast("date").alias("day")).agg(F.count("*").alias("n"))
    base = days.groupBy("tool").agg(F.floor(F.avg("n")).alias("base"))
    return days.join(base, "tool").select("tool", "day", "n", (F.col("n") - F.col("base")).alias("delta"))


@query(f"SELECT tool, day, n FROM (SELECT tool, CAST(created_at AS DATE) AS day, count(*) AS n FROM {_CAP} GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY tool ORDER BY day DESC) <= 3")
def last_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The last three runs of each kind."""
    days = derived(spark, folder, "captured").groupBy("tool", F.col("created_at").cast("date").alias("day")).agg(F.count("*").alias("n"))
    return measures.latest(days.withColumn("id", F.lit(0)), ["tool"], F.desc("day"), 3).select("tool", "day", "n")


@query(f"""SELECT holder, n, CASE WHEN n < 30 THEN 'small' ELSE 'fair' END AS note, round(rate, 6) AS rate, round(0.3 * rate + 0.2 * mean + 0.5 * share, 6) AS axis, rate >= 0.5 AS passed FROM (SELECT holder, count(*) AS n, avg(CAST(quality = 'correct' AS INT)) AS rate, avg(weight) AS mean, avg(CAST(active AS INT)) AS share FROM {_CL} WHERE quality IN ('correct', 'incorrect') GROUP BY 1)""")
def weighted_axes(spark: SparkSession, folder: str) -> DataFrame:
    """A mean of several axes by weights that add to one, with a note where there are few observations."""
    rows = derived(spark, folder, "claims").where("quality IN ('correct', 'incorrect')")
    out = rows.groupBy("holder").agg(F.count("*").alias("n"), F.avg((F.col("quality") == "correct").cast("double")).alias("rate"), F.avg("weight").alias("mean"), F.avg(F.col("active").cast("double")).alias("share"))
    axis = 0.3 * F.col("rate") + 0.2 * F.col("mean") + 0.5 * F.col("share")
    return out.select("holder", "n", F.when(F.col("n") < 30, "small").otherwise("fair").alias("note"), F.round("rate", 6).alias("rate"), F.round(axis, 6).alias("axis"), (F.col("rate") >= 0.5).alias("passed"))


@query(f"""WITH t AS (SELECT page_id, list_sort(list(DISTINCT tag)) AS tags FROM {_TAGS} GROUP BY 1) SELECT a.page_id, round(len(list_intersect(a.tags, b.tags)) / len(b.tags), 6) AS recall FROM t a JOIN t b ON b.page_id = a.page_id + 1""")
def set_recall(spark: SparkSession, folder: str) -> DataFrame:
    """How much of one set another holds."""
    sets = tag_rows(spark, folder).groupBy("page_id").agg(F.collect_set("tag").alias("tags"))
    other = sets.select((F.col("page_id") - 1).alias("page_id"), F.col("tags").alias("want"))
    return sets.join(other, "page_id").select("page_id", F.round(F.size(F.array_intersect("tags", "want")) / F.size("want"), 6).alias("recall"))


# --- listings ---------------------------------------------------------------------------------------


@query(f"""WITH i AS (SELECT dst AS id, count(*) AS n FROM {_E} GROUP BY 1), o AS (SELECT src AS id, count(*) AS n FROM {_E} GROUP BY 1), t AS (SELECT page_id AS id, count(*) AS n FROM (SELECT DISTINCT page_id, date, summary FROM timeline_entries) GROUP BY 1)
SELECT p.id, coalesce(i.n, 0) + coalesce(o.n, 0) + coalesce(t.n, 0) AS connections FROM (SELECT DISTINCT id, slug FROM pages WHERE slug LIKE 'people/%' OR slug LIKE 'companies/%') p LEFT JOIN i USING (id) LEFT JOIN o USING (id) LEFT JOIN t USING (id) ORDER BY connections DESC, p.id LIMIT 25""")
def most_referenced(spark: SparkSession, folder: str) -> DataFrame:
    """Pages under some prefixes by their links and entries, each counted before the join."""
    edges = graph.edges(table(spark, folder, "links"))
    n = lambda df, key: df.groupBy(F.col(key).alias("id")).agg(F.count("*").alias("n"))
    counts = n(edges, "dst").union(n(edges, "src")).union(n(table(spark, folder, "timeline_entries").select("page_id", "date", "summary").distinct(), "page_id")).groupBy("id").agg(F.sum("n").alias("n"))
    rows = _pages(spark, folder, "slug").where("slug LIKE 'people/%' OR slug LIKE 'companies/%'").join(counts, "id", "left")
    return rows.select("id", F.coalesce("n", F.lit(0)).alias("connections")).orderBy(F.desc("connections"), "id").limit(25)


@query(f"""SELECT page_id, array_to_string(list(row_num ORDER BY weight DESC, row_num), ',') AS rows FROM {_CL} WHERE active GROUP BY 1""")
def bucketed_claims(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of each page in order, as one value."""
    order = F.array_sort(F.collect_list(F.struct((-F.col("weight")).alias("w"), "row_num"))).alias("l")
    out = derived(spark, folder, "claims").where("active").groupBy("page_id").agg(order)
    return out.select("page_id", F.array_join(F.transform("l", lambda x: x["row_num"].cast("string")), ",").alias("rows"))


@query(f"""SELECT id FROM {_CL} ORDER BY CASE WHEN active THEN 0 ELSE 1 END, weight DESC NULLS LAST, id LIMIT 60""")
def case_sorted(spark: SparkSession, folder: str) -> DataFrame:
    return derived(spark, folder, "claims").orderBy(F.when(F.col("active"), 0).otherwise(1), F.desc_nulls_last("weight"), "id").limit(60).select("id")


@query(f"""WITH a AS (SELECT *, 'open' AS part FROM {_CL} WHERE quality IS NULL), b AS (SELECT *, 'done' AS part FROM {_CL} WHERE quality IS NOT NULL) SELECT part, count(*) AS n, round(sum(weight), 4) AS weight FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY 1""")
def split_union(spark: SparkSession, folder: str) -> DataFrame:
    rows = derived(spark, folder, "claims")
    parts = rows.where("quality IS NULL").withColumn("part", F.lit("open")).union(rows.where("quality IS NOT NULL").withColumn("part", F.lit("done")))
    return parts.groupBy("part").agg(F.count("*").alias("n"), F.round(F.sum("weight"), 4).alias("weight"))


@query("SELECT v.type, v.label, count(p.id) AS pages FROM (SELECT 'person' AS type, 'who' AS label UNION ALL SELECT 'company', 'who' UNION ALL SELECT 'meeting', 'when') v LEFT JOIN (SELECT DISTINCT id, type FROM pages) p USING (type) GROUP BY ALL")
def literal_union(spark: SparkSession, folder: str) -> DataFrame:
    wanted = spark.createDataFrame([("person", "who"), ("company", "who"), ("meeting", "when")], "type string, label string")
    n = _pages(spark, folder, "type").groupBy("type").agg(F.count("*").alias("pages"))
    return wanted.join(n, "type", "left").select("type", "label", F.coalesce("pages", F.lit(0)).cast("bigint").alias("pages"))


# --- search helpers ---------------------------------------------------------------------------------


@query(f"""WITH e AS (SELECT id, entity_id, fact, valid_from FROM {_FA} WHERE expired_at IS NULL) SELECT a.id, b.id AS near FROM e a JOIN e b ON a.entity_id = b.entity_id AND a.id <> b.id WHERE a.id % 20 = 0 QUALIFY row_number() OVER (PARTITION BY a.id ORDER BY abs(length(a.fact) - length(b.fact)), b.valid_from DESC, b.id) <= 3""")
def nearest_facts(spark: SparkSession, folder: str) -> DataFrame:
    """For a stated set of facts the three of the same entity that are most alike in length."""
    rows = derived(spark, folder, "facts").where("expired_at IS NULL").select("id", "entity_id", F.length("fact").alias("n"), "valid_from")
    one, two = rows.where("id % 20 = 0").select("id", "entity_id", F.col("n").alias("m")), rows.select(F.col("id").alias("near"), "entity_id", "n", "valid_from")
    met = one.join(two, "entity_id").where("id <> near")
    order = Window.partitionBy("id").orderBy(F.abs(F.col("m") - F.col("n")), F.desc("valid_from"), "near")
    return met.withColumn("r", F.row_number().over(order)).where("r <= 3").select("id", "near")


_VT = "(SELECT DISTINCT id, page_id, CAST(embedding AS DOUBLE[]) AS e FROM content_chunks WHERE len(embedding) = 64 AND model = 'embed-large-v3' AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0)"


@query(f"""WITH b AS (SELECT a.id, max(list_cosine_similarity(a.e, b.e)) AS c FROM {_VT} a JOIN {_VT} b ON a.id <> b.id WHERE a.id % 50 = 0 GROUP BY 1) SELECT id, CASE WHEN c >= 0.95 THEN 'duplicate' WHEN c >= 0.92 THEN 'likely' ELSE 'other' END AS class FROM b""")
def duplicate_classes(spark: SparkSession, folder: str) -> DataFrame:
    """Whether a stated set of chunks repeats another, by the nearest vector."""
    rows = table(spark, folder, "content_chunks").where("model = 'embed-large-v3'")
    near = vectors.nearest_of(rows, F.col("id") % 50 == 0, k=1)
    return near.select("id", F.when(F.col("similarity") >= 0.95, "duplicate").when(F.col("similarity") >= 0.92, "likely").otherwise("other").alias("class"))


@query(f"""SELECT DISTINCT id, regexp_matches(' ' || array_to_string(regexp_extract_all(lower(title), '([\\p{{L}}\\p{{N}}]+)', 1), ' ') || ' ', ' (capture log|weekly review) ') AS phrase FROM pages WHERE title IS NOT NULL""")
def title_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """Titles that hold a phrase as a run of words."""
    line = F.concat(F.lit(" "), F.array_join(strings.words_of(F.col("title")), " "), F.lit(" "))
    hit = line.contains(" capture log ") | line.contains(" weekly review ")
    return _pages(spark, folder, "title").where("title IS NOT NULL").select("id", hit.alias("phrase"))


@query(f"""WITH h AS (SELECT dst AS id, ln(1 + count(*)) AS score FROM {_E} GROUP BY 1 ORDER BY score DESC, id LIMIT 20), a AS (SELECT DISTINCT id FROM {_LIVE} WHERE lower(title) = 'capture log') SELECT id, round(max(score), 6) AS score FROM (SELECT h.id, h.score * CASE WHEN a.id IS NULL THEN 1 ELSE 1.1 END AS score FROM h LEFT JOIN a USING (id) UNION ALL SELECT id, (SELECT max(score) FROM h) * 1.1 FROM a WHERE id NOT IN (SELECT id FROM h)) GROUP BY 1""")
def alias_injection(spark: SparkSession, folder: str) -> DataFrame:
    """A ranking into which pages that a query names are put, above its best row; those it holds are raised."""
    degree = graph.edges(table(spark, folder, "links")).groupBy(F.col("dst").alias("id")).agg(F.log(1 + F.count("*").cast("double")).alias("score"))
    head = search.ranked(degree, 20, "id").select("id", "score")
    named = _live(spark, folder).where(F.lower("title") == "capture log").select("id").distinct().withColumn("named", F.lit(True))
    top = head.agg(F.max("score").alias("top"))
    both = head.join(named, "id", "full").crossJoin(top)  # one row
    score = F.when(F.col("score").isNull(), F.col("top") * 1.1).when(F.col("named"), F.col("score") * 1.1).otherwise(F.col("score"))
    return both.select("id", F.round(score, 6).alias("score"))


@query(f"""WITH q AS (SELECT DISTINCT query AS q FROM {_CAP} WHERE id % 500 = 0) SELECT q, regexp_matches(q, '(?i)\\b(latest|changed|update)') AS changing, CASE WHEN regexp_matches(q, '(?i)\\b(latest|changed|update)') THEN 'knowledge_update' WHEN regexp_matches(q, '(?i)\\b(when|since|before)\\b') THEN 'temporal' ELSE 'other' END AS class FROM q""")
def question_classes(spark: SparkSession, folder: str) -> DataFrame:
    """What kind of question each of a stated set of queries is."""
    rows = derived(spark, folder, "captured").where("id % 500 = 0").select(F.col("query").alias("q")).distinct()
    changing = F.col("q").rlike(r"(?i)\b(latest|changed|update)")
    return rows.select("q", changing.alias("changing"), F.when(changing, "knowledge_update").when(F.col("q").rlike(r"(?i)\b(when|since|before)\b"), "temporal").otherwise("other").alias("class"))


@query(r"SELECT DISTINCT id, unnest(list_distinct(regexp_extract_all(compiled_truth, '(?:^|[^\p{L}])([A-Z][a-z]+(?: [A-Z][a-z]+)+)(?:[^\p{L}]|$)', 1))) AS phrase FROM pages WHERE compiled_truth IS NOT NULL")
def capitalised_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """Candidates for names: runs of capitalised words."""
    rows = table(spark, folder, "pages").where("compiled_truth IS NOT NULL")
    return rows.select("id", F.explode(F.array_distinct(F.regexp_extract_all("compiled_truth", F.lit(r"(?:^|[^\p{L}])([A-Z][a-z]+(?: [A-Z][a-z]+)+)(?:[^\p{L}]|$)"), 1))).alias("phrase")).distinct()


@query(r"SELECT doc_id, m[1] AS metric, len(m) AS n FROM (SELECT doc_id, regexp_extract_all(lower(text), '\b(\d+ (?:percent|points|weeks|days))\b', 1) AS m FROM documents) WHERE len(m) > 0")
def text_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Measures that texts state."""
    rows = table(spark, folder, "documents").select("doc_id", F.regexp_extract_all(F.lower("text"), F.lit(r"\b(\d+ (?:percent|points|weeks|days))\b"), 1).alias("m")).where("size(m) > 0")
    return rows.select("doc_id", F.col("m")[0].alias("metric"), F.size("m").cast("bigint").alias("n"))


@query("SELECT doc_id, md5(replace(left(text, 500), chr(0), '')) AS head, length(left(text, 500)) AS n FROM documents WHERE text IS NOT NULL")
def safe_heads(spark: SparkSession, folder: str) -> DataFrame:
    """The beginnings of texts without NUL characters, as a projection of a listing."""
    head = F.replace(F.substring("text", 1, 500), F.lit("\0"), F.lit(""))
    return table(spark, folder, "documents").where("text IS NOT NULL").select("doc_id", F.md5(head).alias("head"), F.length(F.substring("text", 1, 500)).alias("n"))


@query("SELECT DISTINCT id, trim(regexp_replace(lower(split_part(slug, '/', -1)), '[\\s_-]+', ' ', 'g')) AS label, CASE WHEN contains(slug, '/') THEN split_part(slug, '/', 1) ELSE '' END AS folder FROM pages")
def slug_parts(spark: SparkSession, folder: str) -> DataFrame:
    """A slug as its folder and a label."""
    label = F.trim(F.regexp_replace(F.lower(F.element_at(F.split("slug", "/"), -1)), r"[\s_-]+", " "))
    return _pages(spark, folder, "slug").select("id", label.alias("label"), F.when(F.col("slug").contains("/"), F.split_part("slug", F.lit("/"), F.lit(1))).otherwise("").alias("folder"))


@query(f"""SELECT id, concat_ws('-', lower(tool), strftime(created_at, '%Y%m%d'), left(md5(query), 6)) AS slug FROM {_CAP} WHERE id % 100 = 0""")
def run_slugs(spark: SparkSession, folder: str) -> DataFrame:
    """Slugs made from what a run is, the same whenever it is made."""
    rows = derived(spark, folder, "captured").where("id % 100 = 0")
    return rows.select("id", F.concat_ws("-", F.lower("tool"), F.date_format("created_at", "yyyyMMdd"), F.substring(F.md5("query"), 1, 6)).alias("slug"))


@query("SELECT count(*) AS n, CAST(1 AS BIGINT) AS unit FROM (SELECT DISTINCT doc_id FROM documents WHERE text IS NOT NULL AND regexp_matches(text, '[^ \\t\\n\\r\\x0B\\f\\x{85}\\x{A0}\\x{1C}-\\x{1F}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]'))")
def hash_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """Texts with vectors of a plugged-in embedder: how many have one of unit length."""
    made = extensions.embedded(table(spark, folder, "documents").select("doc_id", "text"), "doc_id", "text")
    length = F.round(F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)), 3)
    return made.withColumn("l", length).where("l > 0").agg(F.count("*").alias("n"), F.count_distinct("l").alias("unit"))


@query(f"""SELECT e.user_id, max(e.ts) AS last_at, count(*) AS events FROM events e WHERE e.ts >= TIMESTAMP '2024-01-31' - INTERVAL 90 DAY GROUP BY 1""")
def retained_users(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").where(F.col("ts") >= F.to_timestamp_ntz(F.lit("2024-01-31")) - F.expr("INTERVAL 90 DAY"))
    return rows.groupBy("user_id").agg(F.max("ts").alias("last_at"), F.count("*").alias("events"))


@query(f"""SELECT src, dst, link_type FROM {_E} WHERE src % 7 = 0 UNION ALL SELECT CASE WHEN src % 7 = 1 THEN src - 1 ELSE src END, CASE WHEN dst % 7 = 1 THEN dst - 1 ELSE dst END, link_type FROM {_E} WHERE src % 7 <> 0""")
def redirected_phantoms(spark: SparkSession, folder: str) -> DataFrame:
    """Edges of phantom pages moved to the pages they stand for; others stay."""
    edges = graph.edges(table(spark, folder, "links"))
    ids = edges.select(F.explode(F.array("src", "dst")).alias("old")).where("old % 7 = 1").distinct()
    moved = writes.repointed(edges.where("src % 7 <> 0"), ids.withColumn("new", F.col("old") - 1), ["src", "dst"])
    return edges.where("src % 7 = 0").select("src", "dst", "link_type").union(moved.select("src", "dst", "link_type"))


@query(f"""WITH s AS (SELECT id, epoch_us(coalesce(updated_at, created_at)) AS u FROM {_P}) SELECT count(*) AS pages, count(u) AS dated, round((max(u) - min(u)) / 86400000000.0, 4) AS span FROM s""")
def corpus_span(spark: SparkSession, folder: str) -> DataFrame:
    days = scores.age_days(F.coalesce("updated_at", "created_at"), NOW)
    rows = _pages(spark, folder, "updated_at", "created_at").withColumn("age", days)
    return rows.agg(F.count("*").alias("pages"), F.count("age").alias("dated"), F.round(F.max("age") - F.min("age"), 4).alias("span"))


@query(f"""SELECT id, page_id FROM {_C} WHERE modality = 'text' AND language IS NULL AND chunk_source = 'timeline' AND length(chunk_text) BETWEEN 50 AND 400""")
def filtered_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks by several optional predicates at once, all on the scan."""
    rows = table(spark, folder, "content_chunks").where("modality = 'text' AND language IS NULL AND chunk_source = 'timeline' AND length(chunk_text) BETWEEN 50 AND 400")
    return rows.select("id", "page_id").distinct()
