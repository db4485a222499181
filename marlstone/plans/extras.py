"""Queries over caches, settings, sources and further operations, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import extensions, modes, packs
from ..api import Store
from ..functions import strings, text
from ..operators import cache, graph, hybrid, walks
from ..sources.tables import table
from .derived import derived, sql
from .knowledge import _E, _J, _LIVE, NOW, _live, _pages
from .registry import query
from .searching import _KARM, _VARM, ASKED, _arms
from .writes import _TAGS

_CL = sql("claims")


# --- caches -----------------------------------------------------------------------------------------


def _cache(spark: SparkSession, folder: str) -> DataFrame:
    """A cache of results: for each source's pages one entry, made from the generations of now."""
    pages = _pages(spark, folder, "source_id", "generation")
    made = cache.snapshot(pages, pages.where("id % 10 < 3").select(F.col("source_id").alias("key"), F.col("id").alias("page_id"), F.col("id").alias("rank")))
    age = F.to_timestamp_ntz(F.lit(NOW)) - F.make_dt_interval(F.length("key") % 3)
    return made.select("key", F.array(F.length("key").cast("float"), F.lit(1.0).cast("float")).alias("vector"), F.lit("k").alias("knobs"), age.alias("made_at"), "results", "made_from")


@query("""WITH e AS (SELECT source_id AS key, count(DISTINCT id) AS n FROM pages WHERE id % 10 < 3 AND source_id IS NOT NULL GROUP BY 1), p AS (SELECT DISTINCT source_id FROM pages WHERE id % 10 < 3 AND id % 7 = 0) SELECT key, n AS pages FROM e WHERE length(key) % 3 = 0 AND key NOT IN (SELECT source_id FROM p WHERE source_id IS NOT NULL)""")
def fresh_cache(spark: SparkSession, folder: str) -> DataFrame:
    """Entries that still hold after every seventh page got a new generation."""
    pages = _pages(spark, folder, "generation").withColumn("generation", F.col("generation") + F.when(F.col("id") % 7 == 0, 1).otherwise(0))
    held = cache.fresh(_cache(spark, folder).where("key IS NOT NULL"), pages, NOW)
    return held.select("key", F.size("results").cast("bigint").alias("pages"))


@query("""SELECT source_id AS key, CASE WHEN length(source_id) = 7 THEN TIMESTAMP '2026-01-02' ELSE TIMESTAMP '2026-01-01' - to_days(CAST(length(source_id) % 3 AS INT)) END AS made_at FROM (SELECT DISTINCT source_id FROM pages WHERE id % 10 < 3 AND source_id IS NOT NULL)""")
def put_cache(spark: SparkSession, folder: str) -> DataFrame:
    """Newer entries replace those of their keys, older ones do not."""
    held = _cache(spark, folder).where("key IS NOT NULL")
    newer = held.where("length(key) = 7").withColumn("made_at", F.to_timestamp_ntz(F.lit("2026-01-02 00:00:00")))
    older = held.withColumn("made_at", F.to_timestamp_ntz(F.lit("2020-01-01 00:00:00")))
    return cache.put(cache.put(held, newer), older).select("key", "made_at")


@query("""WITH k AS (SELECT DISTINCT source_id AS key, length(source_id) AS n FROM pages WHERE id % 10 < 3 AND source_id IS NOT NULL), s AS (SELECT key, (n * 7 + 1) / (sqrt(n * n + 1) * sqrt(50)) AS c FROM k) SELECT key, round(c, 6) AS similarity FROM s WHERE c >= 0.92 ORDER BY c DESC, key LIMIT 1""")
def nearest_cached(spark: SparkSession, folder: str) -> DataFrame:
    """The cached query nearest to a query vector."""
    return cache.nearest(_cache(spark, folder).where("key IS NOT NULL"), [7.0, 1.0], "k").select("key", F.round("similarity", 6).alias("similarity"))


# --- settings and searches --------------------------------------------------------------------------


def _intent_sql(column: str) -> str:
    from ..operators.ranking import INTENTS

    return "CASE " + " ".join(f"WHEN regexp_matches(lower({column}), '{words}') THEN '{name}'" for name, words in INTENTS) + " ELSE 'general' END"


@query(f"SELECT doc_id, intent, CASE intent WHEN 'entity' THEN 'low' WHEN 'temporal' THEN 'high' ELSE 'medium' END AS detail, CAST(CASE intent WHEN 'entity' THEN 60 / 1.2 WHEN 'temporal' THEN 60.0 WHEN 'event' THEN 60 / 1.1 ELSE 60.0 END AS DOUBLE) AS k FROM (SELECT doc_id, {_intent_sql('title')} AS intent FROM documents WHERE title IS NOT NULL)")
def intent_settings(spark: SparkSession, folder: str) -> DataFrame:
    """What each title asks for, the detail shown for it and the constant of its keyword arm."""
    from ..operators.ranking import intent

    rows = table(spark, folder, "documents").where("title IS NOT NULL").select("doc_id", intent(F.col("title")).alias("intent"))
    pick = lambda of: F.element_at(F.create_map(*[F.lit(x) for k, v in of.items() for x in (k, v)]), F.col("intent"))
    return rows.select("doc_id", "intent", pick(modes.DETAIL).alias("detail"), pick({k: 60 / w[0] for k, w in modes.WEIGHTS.items()}).alias("k"))


_FUSE = f"(SELECT page_id, sum(w / (60.0 + w * rank)) AS t FROM (SELECT page_id, rank, 1.2 AS w FROM {_KARM} UNION ALL SELECT page_id, rank, 0.9 FROM {_VARM}) GROUP BY 1)"


@query(f"SELECT page_id, round(t / (SELECT max(t) FROM {_FUSE}), 6) AS score FROM {_FUSE}")
def weighted_fusion(spark: SparkSession, folder: str) -> DataFrame:
    """Arms fused with the weights of an intent; in high detail no chunk counts twice."""
    rows = hybrid.fused(_arms(spark, folder), weights=modes.WEIGHTS["entity"][:2], detail="high")
    return rows.select("page_id", F.round("score", 6).alias("score"))


@query(f"SELECT k.page_id, substr(regexp_replace(p.compiled_truth, '[ \\t\\r\\n]+', ' ', 'g'), 1, 240) AS synopsis FROM {_KARM} k JOIN (SELECT DISTINCT id, compiled_truth FROM pages) p ON p.id = k.page_id")
def synopses(spark: SparkSession, folder: str) -> DataFrame:
    """Results with the beginning of their pages: bodies are met by the head of the ranking only."""
    hits = _arms(spark, folder)[0].select("page_id")
    pages = _pages(spark, folder, "compiled_truth").withColumnRenamed("id", "page_id")
    return hits.join(pages, "page_id").select("page_id", F.substring(F.regexp_replace("compiled_truth", "[ \t\r\n]+", " "), 1, 240).alias("synopsis"))


@query(f"""WITH k AS (SELECT page_id, score, rank FROM {_KARM}), f AS (SELECT page_id, score, length(title) AS n, rank FROM k JOIN (SELECT DISTINCT id AS page_id, title FROM pages) USING (page_id)) SELECT page_id, row_number() OVER (ORDER BY CASE WHEN rank < 10 THEN 0 ELSE 1 END, CASE WHEN rank < 10 THEN -n ELSE rank END, page_id) AS place FROM f""")
def reranked_head(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best results ordered anew by a plugged-in scorer (here: the longer title first), the rest behind them."""
    arm = _arms(spark, folder)[0]
    rows = arm.join(_pages(spark, folder, "title").withColumnRenamed("id", "page_id"), "page_id").select(F.col("page_id").alias("id"), "score", "title")
    # ties of length keep the smaller page first
    done = extensions.reranked(rows, ASKED, "title", lambda q, texts: [len(t) for t in texts], head=10)
    order = Window.orderBy(F.desc("reranked"), F.desc("score"), "id")  # some dozens of rows
    return done.select(F.col("id").alias("page_id"), F.row_number().over(order).cast("bigint").alias("place"))


@query(f"""SELECT id, round(score * CASE WHEN slug = 'inbox/capture-log' THEN 1.25 WHEN lower(title) = 'capture log' THEN 1.1 ELSE 1 END, 6) AS score FROM (SELECT DISTINCT id, slug, title, ln(2 + length(slug)) AS score FROM {_LIVE})""")
def equality_boosts(spark: SparkSession, folder: str) -> DataFrame:
    """Scores raised where a query is a page's very slug or title."""
    rows = _live(spark, folder).select("id", "slug", "title", F.log(2 + F.length("slug").cast("double")).alias("score")).distinct()
    factor = F.when(F.col("slug") == "inbox/capture-log", 1.25).when(F.lower("title") == "capture log", 1.1).otherwise(1.0)
    return rows.select("id", F.round(F.col("score") * factor, 6).alias("score"))


@query(f"""WITH RECURSIVE h AS (SELECT DISTINCT id FROM pages WHERE slug = 'inbox/capture-log' AND source_id = 'capture-inbox'), w AS (SELECT id AS node, 0 AS hop FROM h UNION SELECT e.src, w.hop + 1 FROM w JOIN (SELECT DISTINCT src, dst FROM {_E} WHERE link_type = 'founded') e ON e.dst = w.node WHERE w.hop < 2) SELECT node, min(hop) AS hop FROM w GROUP BY 1""")
def relation_answer(spark: SparkSession, folder: str) -> DataFrame:
    """A question about a relation: its seed is resolved, and links of its type are walked the way it asks."""
    seeds, kind, way = modes.relation("Who founded inbox/capture-log?")
    edges = graph.edges(table(spark, folder, "links")).where(F.col("link_type") == kind)
    step = edges if way == "out" else edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "link_type")
    found = walks.resolved(spark.createDataFrame([(s,) for s in seeds], "name string"), _pages(spark, folder, "slug", "title")).where("id IS NOT NULL").select("id")
    return walks.reach(found, step, 2).select("node", "hop")


@query(f"""WITH t AS (SELECT DISTINCT id, title, slug, list_distinct(flatten(list_transform(list_filter(string_split(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3))))) AS g FROM pages WHERE title IS NOT NULL),
q AS (SELECT list_distinct(flatten(list_transform(['capture', 'logs'], lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3))))) AS g), e AS (SELECT id FROM t WHERE lower(title) = 'capture logs'),
f AS (SELECT id, len(list_intersect(t.g, q.g)) / len(list_distinct(t.g || q.g)) AS s FROM t, q WHERE (SELECT count(*) FROM e) = 0 AND len(list_intersect(t.g, q.g)) / len(list_distinct(t.g || q.g)) >= 0.3)
SELECT id, round(s, 6) AS score FROM (SELECT id, 1.0 AS s FROM e UNION ALL SELECT * FROM f) ORDER BY s DESC, id LIMIT 5""")
def exact_or_fuzzy(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of exactly a title, else the five most like it."""
    rows = _pages(spark, folder, "title").where("title IS NOT NULL")
    exact = rows.where(F.lower("title") == "capture logs").select("id", F.lit(1.0).alias("s"))
    none = exact.agg((F.count("*") == 0).alias("none"))
    near = rows.withColumn("s", text.similarity(F.col("title"), F.lit("capture logs"))).where("s >= 0.3").crossJoin(none).where("none").select("id", "s")  # one row
    return exact.union(near).orderBy(F.desc("s"), "id").limit(5).select("id", F.round("s", 6).alias("score"))


# --- packs and repairs ------------------------------------------------------------------------------


@query("SELECT DISTINCT id AS page_id, slug AS alias, regexp_replace(slug, '^[^/]+/', '') AS stands_for FROM pages WHERE type = 'concept' AND contains(slug, '/')")
def pages_as_aliases(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of a type turned into aliases of what their slugs name."""
    rows = _pages(spark, folder, "slug", "type").where("type = 'concept' AND slug LIKE '%/%'")
    return rows.select(F.col("id").alias("page_id"), F.col("slug").alias("alias"), F.regexp_replace("slug", "^[^/]+/", "").alias("stands_for"))


_STAR = f"(SELECT min(tag) OVER (PARTITION BY left(tag, 2)) AS a, tag AS b FROM (SELECT DISTINCT tag FROM {_TAGS}))"


@query(f"SELECT a, b FROM {_STAR} WHERE a <> b UNION SELECT b, a FROM {_STAR} WHERE a <> b")
def alias_graph(spark: SparkSession, folder: str) -> DataFrame:
    """A symmetric graph of aliases: each tag is one of the first tag with its two first letters."""
    from .writes import tag_rows

    tags = tag_rows(spark, folder).select("tag").distinct().withColumn("k", F.substring("tag", 1, 2))
    first = tags.groupBy("k").agg(F.min("tag").alias("src"))
    one = tags.join(first, "k").where("src <> tag").select("src", F.col("tag").alias("dst"))
    return walks.both_ways(one).select(F.col("src").alias("a"), F.col("dst").alias("b")).distinct()


@query(f"""SELECT id, CASE WHEN contains(coalesce(compiled_truth, ''), '<!-- timeline -->') THEN 'marked' WHEN coalesce(timeline, '') <> '' THEN 'apart' ELSE 'none' END AS timeline FROM (SELECT DISTINCT id, compiled_truth, timeline FROM pages)""")
def timeline_places(spark: SparkSession, folder: str) -> DataFrame:
    """Where pages keep their timelines; bodies are tested on the scan."""
    place = F.when(F.coalesce("compiled_truth", F.lit("")).contains("<!-- timeline -->"), "marked").when(F.coalesce("timeline", F.lit("")) != "", "apart").otherwise("none")
    return table(spark, folder, "pages").select("id", place.alias("timeline")).distinct()


@query(r"""SELECT DISTINCT id, md5(regexp_replace(coalesce(compiled_truth, ''), '(?s)<!-- facts -->.*?<!-- /facts -->\n?', '', 'g')) AS body FROM pages""")
def bodies_without_fences(spark: SparkSession, folder: str) -> DataFrame:
    body = strings.without_section(F.coalesce("compiled_truth", F.lit("")), "<!-- facts -->", "<!-- /facts -->")
    return table(spark, folder, "pages").select("id", F.md5(body).alias("body")).distinct()


@query("SELECT DISTINCT id, trim(regexp_replace(lower(coalesce(title, '')), '[^a-z0-9]+', '_', 'g'), '_') AS label FROM pages")
def metric_labels(spark: SparkSession, folder: str) -> DataFrame:
    label = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce("title", F.lit(""))), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return _pages(spark, folder, "title").select("id", label.alias("label"))


@query(f"SELECT id, regexp_replace(claim, '^[^A-Za-z0-9]+', '') AS claim, list_contains(['mail', 'meeting'], kind) AS told FROM {_CL}")
def stripped_claims(spark: SparkSession, folder: str) -> DataFrame:
    rows = derived(spark, folder, "claims")
    return rows.select("id", F.regexp_replace("claim", "^[^A-Za-z0-9]+", "").alias("claim"), F.array_contains(F.array(F.lit("mail"), F.lit("meeting")), F.col("kind")).alias("told"))


# --- further operations -----------------------------------------------------------------------------


@query(f"""WITH j AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC NULLS LAST, status DESC) AS n FROM {_J}) WHERE n = 1) SELECT 'pages' AS what, count(DISTINCT id) AS n FROM pages WHERE deleted_at IS NULL UNION ALL SELECT 'sources behind', count(*) FROM sources WHERE NOT coalesce(archived, false) AND (last_sync_at IS NULL OR last_sync_at < TIMESTAMP '{NOW}' - INTERVAL 30 DAY) UNION ALL SELECT 'jobs ' || status, count(*) FROM j GROUP BY status""")
def op_status_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return Store(spark, folder).run("get_status_snapshot", now=NOW)


@query(f"""SELECT 'unembedded chunks' AS fault, count(DISTINCT id) AS n FROM content_chunks WHERE embedding IS NULL UNION ALL SELECT 'stale hashes', count(DISTINCT id) FROM pages WHERE compiled_truth IS NOT NULL AND lower(content_hash) IS DISTINCT FROM sha256(compiled_truth) UNION ALL SELECT 'links to nowhere', count(*) FROM {_E} e WHERE NOT EXISTS (SELECT 1 FROM pages p WHERE p.id = e.dst) UNION ALL SELECT 'chunks of no page', count(DISTINCT id) FROM content_chunks c WHERE NOT EXISTS (SELECT 1 FROM pages p WHERE p.id = c.page_id)""")
def op_run_doctor(spark: SparkSession, folder: str) -> DataFrame:
    return Store(spark, folder).run("run_doctor")


@query("SELECT count(DISTINCT id) AS pages, count(DISTINCT source_id) AS sources, max(updated_at) AS newest FROM pages WHERE deleted_at IS NULL")
def op_identity(spark: SparkSession, folder: str) -> DataFrame:
    return Store(spark, folder).run("get_identity")


@query(f"SELECT domain, count(*) AS n, round(avg(power(weight - CASE quality WHEN 'correct' THEN 1.0 WHEN 'incorrect' THEN 0.0 END, 2)), 6) AS brier FROM {_CL} WHERE holder = 'holder-1' GROUP BY 1")
def op_calibration_profile(spark: SparkSession, folder: str) -> DataFrame:
    return Store(spark, folder).run("get_calibration_profile", holder="holder-1").select("domain", F.col("claims").alias("n"), F.round("brier", 6).alias("brier"))


@query("SELECT doc_id FROM documents WHERE kind IN ('chat', 'meeting') AND created_at >= TIMESTAMP '2025-01-01' ORDER BY created_at DESC, doc_id LIMIT 20")
def op_recent_transcripts(spark: SparkSession, folder: str) -> DataFrame:
    return Store(spark, folder).run("get_recent_transcripts", since="2025-01-01").select("doc_id")


@query("SELECT doc_id, 'amount' AS kind, unnest(regexp_extract_all(text, '\\b(\\d+ percent)\\b', 1)) AS value FROM documents WHERE kind = 'howto' AND text IS NOT NULL")
def op_extract_facts(spark: SparkSession, folder: str) -> DataFrame:
    """A plugged-in extractor over the texts of a kind."""
    import re

    amounts = re.compile(r"\b(\d+ percent)\b", re.A)
    return Store(spark, folder).run("extract_facts", kind="howto", extract=lambda t: [("amount", x) for x in amounts.findall(t)])


@query(f"""SELECT p.slug, CASE WHEN p.slug = 'notes/gone' THEN 'D' ELSE 'A' END AS op FROM (SELECT 'notes/new-one' AS slug) p""")
def op_sync(spark: SparkSession, folder: str) -> DataFrame:
    """A change set applied to a source: one page comes, one goes; here both are told by their slugs."""
    store = Store(spark, folder)
    new = spark.range(1).select(F.lit("default").alias("source_id"), F.lit("notes/new-one").alias("slug"), F.lit("New").alias("title"), F.lit("body").alias("compiled_truth"))
    gone = spark.range(1).select(F.lit("default").alias("source_id"), F.lit("notes/gone").alias("slug"))
    after = store.run("sync", new=new, gone=gone)
    return after["pages"].select("slug").distinct().where("slug IN ('notes/new-one', 'notes/gone')").withColumn("op", F.lit("A"))


@query("SELECT count(DISTINCT id) AS pages FROM pages WHERE type IN ('person', 'company') AND deleted_at IS NULL")
def op_apply_pack(spark: SparkSession, folder: str) -> DataFrame:
    """A pack changed and applied: two types become one."""
    pack = packs.DEFAULT.changed(types=(packs.PageType("party", ("people/", "companies/"), ("person", "company")),))
    store = Store(spark, folder).run("schema_apply", pack=pack)
    return store["pages"].where("type = 'party' AND deleted_at IS NULL").agg(F.countDistinct("id").alias("pages"))
