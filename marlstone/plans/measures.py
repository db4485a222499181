"""Queries over aggregates, windows, listings and sets, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scores, strings
from ..operators import graph, measures, search
from ..sources.tables import table
from .derived import derived, sql
from .knowledge import _E, _J, NOW, _chunks, _jobs, _pages
from .registry import query
from .writes import _TAGS, tag_rows

_C, _FA, _CAP = sql("claims"), sql("facts"), sql("captured")
_O = "CASE quality WHEN 'correct' THEN 1.0 WHEN 'incorrect' THEN 0.0 END"


@query(f"""SELECT holder, domain, count(*) AS claims, count(quality) AS resolved, round(avg(power(weight - {_O}, 2)), 6) AS brier, round(avg(CASE WHEN {_O} IS NOT NULL THEN CAST((weight >= 0.5) = ({_O} = 1) AS INT) END), 6) AS directional,
round(count(*) FILTER (quality = 'correct') / nullif(count(*) FILTER (quality IN ('correct', 'incorrect')), 0), 6) AS accuracy FROM {_C} GROUP BY ALL""")
def holder_scorecards(spark: SparkSession, folder: str) -> DataFrame:
    """Each holder's record in each domain: accuracy, Brier score, direction."""
    out = measures.scorecard(derived(spark, folder, "claims"), ["holder", "domain"])
    return out.select("holder", "domain", "claims", "resolved", *[F.round(c, 6).alias(c) for c in ("brier", "directional", "accuracy")])


@query(f"""SELECT holder, bucket, n, CASE WHEN n >= 5 THEN round(rate, 6) END AS hit_rate FROM (SELECT holder, CAST(least(floor(weight * 4), 3) AS INT) AS bucket, count(*) AS n, avg({_O}) AS rate FROM {_C} WHERE quality IN ('correct', 'incorrect') GROUP BY ALL)""")
def bucket_forecasts(spark: SparkSession, folder: str) -> DataFrame:
    """What claims of each weight came to, where there are five outcomes or more."""
    return measures.forecast(derived(spark, folder, "claims"), ["holder"]).withColumn("hit_rate", F.round("hit_rate", 6))


@query(f"""WITH f AS (SELECT holder, CAST(least(floor(weight * 4), 3) AS INT) AS bucket, count(*) AS n, avg({_O}) AS rate FROM {_C} WHERE quality IN ('correct', 'incorrect') GROUP BY ALL)
SELECT c.page_id, c.row_num, round(f.rate, 6) AS expected FROM {_C} c LEFT JOIN f ON f.holder = c.holder AND f.bucket = CAST(least(floor(c.weight * 4), 3) AS INT) AND f.n >= 5 WHERE c.quality IS NULL""")
def open_forecasts(spark: SparkSession, folder: str) -> DataFrame:
    """Open claims with the hit rate of their holder's claims of like weight."""
    claims = derived(spark, folder, "claims")
    known = measures.forecast(claims, ["holder"]).select("holder", "bucket", "hit_rate")
    rows = claims.where("quality IS NULL").withColumn("bucket", F.least(F.floor(F.col("weight") * 4), F.lit(3)).cast("int"))
    return rows.join(known, ["holder", "bucket"], "left").select("page_id", "row_num", F.round("hit_rate", 6).alias("expected"))


@query(f"SELECT kind, round(sum(CAST(length(claim) AS DOUBLE) * weight) / nullif(sum(weight), 0), 4) AS mean FROM {_C} GROUP BY 1")
def weighted_means(spark: SparkSession, folder: str) -> DataFrame:
    return derived(spark, folder, "claims").groupBy("kind").agg(F.round(measures.weighted_mean(F.length("claim").cast("double"), F.col("weight")), 4).alias("mean"))


@query(f"""SELECT kind, count(*) AS facts, count(*) FILTER (expired_at IS NULL AND valid_until IS NULL) AS active, count(*) FILTER (expired_at IS NOT NULL) AS expired, count(*) FILTER (superseded_by IS NOT NULL) AS superseded, count(*) FILTER (metric IS NOT NULL) AS measured FROM {_FA} GROUP BY 1""")
def fact_health(spark: SparkSession, folder: str) -> DataFrame:
    rows = derived(spark, folder, "facts")
    n = lambda c, name: F.count_if(c).alias(name)
    return rows.groupBy("kind").agg(
        F.count("*").alias("facts"), n(F.col("expired_at").isNull() & F.col("valid_until").isNull(), "active"), n(F.col("expired_at").isNotNull(), "expired"), n(F.col("superseded_by").isNotNull(), "superseded"), n(F.col("metric").isNotNull(), "measured")
    )


@query(f"SELECT entity_id, count(*) AS facts FROM {_FA} WHERE expired_at IS NULL GROUP BY 1 ORDER BY facts DESC, entity_id LIMIT 5")
def top_entities(spark: SparkSession, folder: str) -> DataFrame:
    return derived(spark, folder, "facts").where("expired_at IS NULL").groupBy("entity_id").agg(F.count("*").alias("facts")).orderBy(F.desc("facts"), "entity_id").limit(5)


@query(f"SELECT id, entity_id FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY valid_from DESC, id) AS n FROM {_FA} WHERE expired_at IS NULL) WHERE n <= 3")
def newest_facts(spark: SparkSession, folder: str) -> DataFrame:
    """The three newest open facts of each entity."""
    rows = derived(spark, folder, "facts").where("expired_at IS NULL").select("id", "entity_id", "valid_from")
    return measures.latest(rows, ["entity_id"], F.desc("valid_from"), 3).select("id", "entity_id")


@query(f"SELECT id, expired_at IS NOT NULL AND superseded_by IS NOT NULL AS replaced FROM {_FA} WHERE expired_at IS NOT NULL OR superseded_by IS NOT NULL")
def closed_and_replaced(spark: SparkSession, folder: str) -> DataFrame:
    rows = derived(spark, folder, "facts").where("expired_at IS NOT NULL OR superseded_by IS NOT NULL")
    return rows.select("id", (F.col("expired_at").isNotNull() & F.col("superseded_by").isNotNull()).alias("replaced"))


@query(f"SELECT session, count(*) AS facts, min(id) AS first_id FROM {_FA} WHERE valid_from >= DATE '2025-01-01' GROUP BY 1")
def session_facts(spark: SparkSession, folder: str) -> DataFrame:
    return derived(spark, folder, "facts").where("valid_from >= DATE '2025-01-01'").groupBy("session").agg(F.count("*").alias("facts"), F.min("id").alias("first_id"))


@query(f"""SELECT entity_id, metric, valid_from AS day, amount, round(amount / nullif(lag(amount) OVER w, 0) - 1, 6) AS change, lag(amount) OVER w IS NOT NULL AND amount <= 0.9 * lag(amount) OVER w AS regressed FROM {_FA} WHERE metric IS NOT NULL WINDOW w AS (PARTITION BY entity_id, metric ORDER BY valid_from, id)""")
def trajectories(spark: SparkSession, folder: str) -> DataFrame:
    """Each entity's metrics through time, with the change of each step."""
    order = Window.partitionBy("entity_id", "metric").orderBy("valid_from", "id")
    rows = derived(spark, folder, "facts").where("metric IS NOT NULL").withColumn("before", F.lag("amount").over(order))
    change = F.when(F.col("before") != 0, F.col("amount") / F.col("before") - 1)
    return rows.select("entity_id", "metric", F.col("valid_from").alias("day"), "amount", F.round(change, 6).alias("change"), F.coalesce(F.col("amount") <= 0.9 * F.col("before"), F.lit(False)).alias("regressed"))


@query(f"""SELECT entity_id, metric, count(*) AS points, round(avg(CAST(up AS INT)), 6) AS rising, count(*) FILTER (amount <= 0.9 * before) AS flags FROM (SELECT *, lag(amount) OVER w AS before, amount > lag(amount) OVER w AS up FROM {_FA} WHERE metric IS NOT NULL WINDOW w AS (PARTITION BY entity_id, metric ORDER BY valid_from, id)) GROUP BY ALL HAVING count(*) >= 2""")
def growth_flags(spark: SparkSession, folder: str) -> DataFrame:
    """How steadily a metric grows and how often it falls by a tenth."""
    order = Window.partitionBy("entity_id", "metric").orderBy("valid_from", "id")
    rows = derived(spark, folder, "facts").where("metric IS NOT NULL").withColumn("before", F.lag("amount").over(order))
    out = rows.groupBy("entity_id", "metric").agg(F.count("*").alias("points"), F.round(F.avg((F.col("amount") > F.col("before")).cast("double")), 6).alias("rising"), F.count_if(F.col("amount") <= 0.9 * F.col("before")).alias("flags"))
    return out.where("points >= 2")


@query(f"""SELECT p.id, round(0.5 * CAST(coalesce(bool_or(t.tag IN (SELECT min(tag) FROM {_TAGS})), false) AS INT) + least(0.1 * coalesce(max(c.n), 0), 0.3) + 0.1 * coalesce(max(c.w), 0) + 0.1 * coalesce(max(c.h), 0), 6) AS weight FROM (SELECT DISTINCT id FROM pages) p LEFT JOIN {_TAGS} t ON t.page_id = p.id
LEFT JOIN (SELECT page_id, count(*) AS n, avg(weight) AS w, count(*) FILTER (holder = 'holder-1') / count(*) AS h FROM {_C} WHERE active GROUP BY 1) c ON c.page_id = p.id GROUP BY 1""")
def emotional_weights(spark: SparkSession, folder: str) -> DataFrame:
    """A page's weight from a marked tag, its claims' number, weights and holders; tags and claims are counted before they meet."""
    tags = tag_rows(spark, folder)
    marked = tags.join(tags.agg(F.min("tag").alias("tag")), "tag", "left_semi").select(F.col("page_id").alias("id")).distinct().withColumn("hit", F.lit(0.5))
    claims = derived(spark, folder, "claims").where("active").groupBy(F.col("page_id").alias("id")).agg(F.count("*").alias("n"), F.avg("weight").alias("w"), F.avg((F.col("holder") == "holder-1").cast("double")).alias("h"))
    rows = _pages(spark, folder).join(marked, "id", "left").join(claims, "id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return rows.select("id", F.round(zero("hit") + F.least(0.1 * zero("n"), F.lit(0.3)) + 0.1 * zero("w") + 0.1 * zero("h"), 6).alias("weight"))


@query(f"""SELECT page_id, array_to_string(list_sort(list(DISTINCT tag)), ',') AS tags, count(DISTINCT tag) AS n FROM {_TAGS} GROUP BY 1""")
def page_tags(spark: SparkSession, folder: str) -> DataFrame:
    return tag_rows(spark, folder).groupBy("page_id").agg(F.array_join(F.array_sort(F.collect_set("tag")), ",").alias("tags"), F.countDistinct("tag").alias("n"))


@query(f"""SELECT tool, count(*) AS queries, count(*) FILTER (latency > 50) AS slow, round(avg(nullif(latency, 0)), 4) AS mean, count(DISTINCT client) AS clients FROM {_CAP} WHERE created_at >= TIMESTAMP '2024-01-10' GROUP BY 1""")
def request_stats(spark: SparkSession, folder: str) -> DataFrame:
    rows = derived(spark, folder, "captured").where("created_at >= TIMESTAMP_NTZ '2024-01-10'")
    return rows.groupBy("tool").agg(F.count("*").alias("queries"), F.count_if(F.col("latency") > 50).alias("slow"), F.round(F.avg(F.nullif(F.col("latency"), F.lit(0.0))), 4).alias("mean"), F.countDistinct("client").alias("clients"))


@query(f"""SELECT client, count(*) AS requests, count(*) FILTER (tool = 'error') AS errors, max(created_at) AS last_at, round(sum(latency), 2) AS spent FROM {_CAP} GROUP BY 1""")
def client_counters(spark: SparkSession, folder: str) -> DataFrame:
    return derived(spark, folder, "captured").groupBy("client").agg(F.count("*").alias("requests"), F.count_if(F.col("tool") == "error").alias("errors"), F.max("created_at").alias("last_at"), F.round(F.sum("latency"), 2).alias("spent"))


@query(f"""SELECT tool, intent, sum(n) AS queries, round(sum(n) FILTER (hit) / sum(n), 6) AS hit_rate FROM (SELECT tool, CASE WHEN id % 3 = 0 THEN 'entity' ELSE 'general' END AS intent, latency < 30 AS hit, count(*) AS n FROM {_CAP} GROUP BY ALL) GROUP BY ROLLUP (tool, intent)""")
def telemetry(spark: SparkSession, folder: str) -> DataFrame:
    """Queries and hit rates by tool and intent, with totals."""
    rows = derived(spark, folder, "captured").select("tool", F.when(F.col("id") % 3 == 0, "entity").otherwise("general").alias("intent"), (F.col("latency") < 30).alias("hit"))
    out = rows.rollup("tool", "intent").agg(F.count("*").alias("queries"), F.avg(F.col("hit").cast("double")).alias("rate"))
    return out.select("tool", "intent", "queries", F.round("rate", 6).alias("hit_rate"))


@query(f"""SELECT id, tool FROM {_CAP} WHERE tool = 'purchase' AND created_at >= TIMESTAMP '2024-01-05' ORDER BY created_at DESC, id LIMIT 50""")
def recent_captures(spark: SparkSession, folder: str) -> DataFrame:
    rows = derived(spark, folder, "captured").where("tool = 'purchase' AND created_at >= TIMESTAMP_NTZ '2024-01-05'")
    return rows.orderBy(F.desc("created_at"), "id").limit(50).select("id", "tool")


@query(f"""SELECT dimension, count(score) AS n, round(avg(score), 6) AS mean, min(score) AS low, max(score) AS high, count(score) >= 2 AND avg(score) >= 4 AND min(score) >= 0.5 AS passed FROM (SELECT kind AS dimension, weight * 10 AS score FROM {_C}) GROUP BY 1""")
def panel_scores(spark: SparkSession, folder: str) -> DataFrame:
    rows = derived(spark, folder, "claims").select(F.col("kind").alias("dimension"), (F.col("weight") * 10).alias("score"))
    return measures.panel(rows, "dimension", "score", 4.0, 0.5).withColumn("mean", F.round("mean", 6))


@query(f"""WITH v AS (SELECT page_id, quality AS verdict, count(*) AS votes, min(weight) AS confidence FROM {_C} WHERE quality IS NOT NULL GROUP BY ALL) SELECT page_id, verdict, votes, confidence FROM v QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY votes DESC, verdict = 'unresolvable', verdict) = 1""")
def majority_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    votes = derived(spark, folder, "claims").where("quality IS NOT NULL").select("page_id", F.col("quality").alias("verdict"), F.col("weight").alias("confidence"))
    return measures.majority(votes, ["page_id"], "verdict", "confidence")


@query(f"""SELECT DISTINCT id, round(CASE WHEN title IS NOT NULL THEN 0.2 ELSE 0 END + CASE WHEN length(compiled_truth) >= 200 THEN 0.35 ELSE 0 END + CASE WHEN coalesce(timeline, '') <> '' THEN 0.25 ELSE 0 END + CASE WHEN contains(compiled_truth, '[[') THEN 0.2 ELSE 0 END, 3) AS score FROM pages""")
def page_rubric(spark: SparkSession, folder: str) -> DataFrame:
    """A weighted score of what a page holds; the checks run on the scan."""
    score = measures.rubric({
        "title": (F.col("title").isNotNull(), 0.2), "body": (F.length("compiled_truth") >= 200, 0.35), "timeline": (F.coalesce("timeline", F.lit("")) != "", 0.25), "links": (F.col("compiled_truth").contains("[["), 0.2),
    })
    return table(spark, folder, "pages").select("id", score.alias("score")).distinct()


@query(f"""SELECT count(*) AS n, round(avg(CAST(e AS INT)), 6) AS share, round(sqrt(avg(CAST(e AS INT)) * (1 - avg(CAST(e AS INT))) / count(*)), 6) AS error FROM (SELECT id, embedding IS NOT NULL AS e FROM (SELECT DISTINCT * FROM content_chunks)) WHERE CAST('0x' || left(md5(CAST(id AS VARCHAR)), 8) AS BIGINT) % 4 = 0""")
def sampled_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """Coverage estimated from a quarter of the chunks, with its standard error: a sampling operator."""
    rows = _chunks(spark, folder, F.col("embedding").isNotNull().alias("e"))
    return measures.sampled_share(rows, "id", F.col("e"), 4).select("n", F.round("share", 6).alias("share"), F.round("error", 6).alias("error"))


@query(f"""SELECT count(*) AS n, CAST(sum(CAST(CAST('0x' || left(sha256(concat_ws('|', coalesce(source_id, '~'), coalesce(slug, '~'))), 12) AS BIGINT) AS HUGEINT)) AS VARCHAR) AS fingerprint FROM (SELECT DISTINCT source_id, slug FROM pages)""")
def key_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return measures.fingerprint(table(spark, folder, "pages").select("source_id", "slug").distinct(), ["source_id", "slug"])


@query(f"""SELECT end_id AS page_id, count(*) AS pairs, max(sev) AS severity FROM (SELECT unnest([src, dst]) AS end_id, CASE link_type WHEN 'mentions' THEN 1 WHEN 'related' THEN 2 ELSE 3 END AS sev FROM {_E}) GROUP BY 1 ORDER BY pairs DESC, end_id LIMIT 10""")
def pair_severity(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs exploded to both ends: how many and how grave, the ten most."""
    rows = graph.edges(table(spark, folder, "links")).select(F.explode(F.array("src", "dst")).alias("page_id"), F.when(F.col("link_type") == "mentions", 1).when(F.col("link_type") == "related", 2).otherwise(3).alias("sev"))
    return rows.groupBy("page_id").agg(F.count("*").alias("pairs"), F.max("sev").alias("severity")).orderBy(F.desc("pairs"), "page_id").limit(10)


@query(f"""SELECT tag, count(*) AS pages, CASE WHEN count(*) >= 20 THEN 'core' WHEN count(*) >= 5 THEN 'known' ELSE 'rare' END AS tier FROM {_TAGS} GROUP BY 1""")
def concept_tiers(spark: SparkSession, folder: str) -> DataFrame:
    out = tag_rows(spark, folder).groupBy("tag").agg(F.count("*").alias("pages"))
    return out.withColumn("tier", F.when(F.col("pages") >= 20, "core").when(F.col("pages") >= 5, "known").otherwise("rare"))


@query("""SELECT source_id, count(*) AS pages, count(nullif(type, 'note')) AS typed, count(DISTINCT split_part(slug, '/', 1)) AS prefixes FROM (SELECT DISTINCT id, source_id, type, slug FROM pages) GROUP BY 1""")
def typed_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = _pages(spark, folder, "source_id", "type", "slug")
    return rows.groupBy("source_id").agg(F.count("*").alias("pages"), F.count(F.nullif(F.col("type"), F.lit("note"))).alias("typed"), F.countDistinct(F.split_part("slug", F.lit("/"), F.lit(1))).alias("prefixes"))


@query("""SELECT p.prefix, count(x.id) AS pages FROM (VALUES ('people/'), ('companies/'), ('nowhere/'), ('meetings/')) p(prefix) LEFT JOIN (SELECT DISTINCT id, slug FROM pages) x ON starts_with(x.slug, p.prefix) GROUP BY 1 HAVING count(x.id) = 0""")
def unused_prefixes(spark: SparkSession, folder: str) -> DataFrame:
    """Declared prefixes that no page has: an anti-join on the first segment."""
    wanted = spark.createDataFrame([("people/",), ("companies/",), ("nowhere/",), ("meetings/",)], "prefix string")
    known = table(spark, folder, "pages").select(F.concat(F.split_part("slug", F.lit("/"), F.lit(1)), F.lit("/")).alias("prefix")).distinct()
    return wanted.join(known, "prefix", "left_anti").withColumn("pages", F.lit(0).cast("bigint"))


@query("""SELECT DISTINCT regexp_extract(slug, '^[^/]+/[^/-]+', 0) AS prefix FROM pages WHERE regexp_matches(slug, '^[^/]+/[^/-]+')""")
def two_segment_prefixes(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select(F.regexp_extract("slug", "^[^/]+/[^/-]+", 0).alias("prefix")).where("prefix <> ''").distinct()


@query(f"""WITH l AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC NULLS LAST, status DESC) AS n FROM {_J}) SELECT queue, count(*) AS jobs, count(*) FILTER (status = 'failed') AS failed, round(avg(nullif(attempts_made, 0)), 6) AS attempts, max(updated_at) AS last_at FROM l WHERE n = 1 GROUP BY 1""")
def queue_status(spark: SparkSession, folder: str) -> DataFrame:
    rows = _jobs(spark, folder, "queue", "attempts_made")
    return rows.groupBy("queue").agg(F.count("*").alias("jobs"), F.count_if(F.col("status") == "failed").alias("failed"), F.round(F.avg(F.nullif(F.col("attempts_made"), F.lit(0))), 6).alias("attempts"), F.max("updated_at").alias("last_at"))


@query(f"""WITH l AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC NULLS LAST, status DESC) AS n FROM {_J}) SELECT id, CASE WHEN status = 'delayed' AND delay_until <= TIMESTAMP '{NOW}' THEN 'waiting' WHEN status = 'active' AND timeout_at < TIMESTAMP '{NOW}' THEN 'dead' ELSE status END AS status FROM l WHERE n = 1""")
def swept_jobs(spark: SparkSession, folder: str) -> DataFrame:
    """Jobs after a sweep: due delayed ones wait, those beyond their deadline are dead."""
    rows = _jobs(spark, folder, "delay_until", "timeout_at")
    now = F.to_timestamp_ntz(F.lit(NOW))
    status = F.when((F.col("status") == "delayed") & (F.col("delay_until") <= now), "waiting").when((F.col("status") == "active") & (F.col("timeout_at") < now), "dead").otherwise(F.col("status"))
    return rows.select("id", status.alias("status"))


# --- windows and ranks ------------------------------------------------------------------------------


@query(f"""WITH d AS (SELECT dst AS id, count(*) AS n FROM {_E} GROUP BY 1), p AS (SELECT id, slug, split_part(slug, '/', 1) AS prefix, coalesce(date_diff('day', CAST(updated_at AS DATE), DATE '2026-01-01'), 0) AS stale FROM (SELECT DISTINCT id, slug, updated_at FROM pages WHERE deleted_at IS NULL))
SELECT prefix, p.id FROM p LEFT JOIN d USING (id) QUALIFY row_number() OVER (PARTITION BY prefix ORDER BY stale DESC, coalesce(n, 0) DESC, slug, p.id) = 1""")
def stalest_by_prefix(spark: SparkSession, folder: str) -> DataFrame:
    """The stalest page of each prefix: an aggregate over the order."""
    degree = graph.edges(table(spark, folder, "links")).groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("n"))
    rows = _pages(spark, folder, "slug", "updated_at", "deleted_at").where("deleted_at IS NULL").join(degree, "id", "left")
    stale = F.coalesce(F.date_diff(F.lit("2026-01-01").cast("date"), F.col("updated_at").cast("date")), F.lit(0))
    best = F.min(F.struct((-stale).alias("a"), (-F.coalesce("n", F.lit(0))).alias("b"), "slug", "id")).alias("m")
    return rows.groupBy(F.split_part("slug", F.lit("/"), F.lit(1)).alias("prefix")).agg(best).select("prefix", "m.id")


@query(f"""WITH r AS (SELECT id, score, row_number() OVER (ORDER BY score DESC, id) AS pos FROM (SELECT dst AS id, ln(1 + count(*)) AS score FROM {_E} GROUP BY 1) QUALIFY pos <= 20), a AS (SELECT e.dst AS id, count(DISTINCT e.src) AS n FROM {_E} e WHERE e.src IN (SELECT id FROM r) AND e.dst IN (SELECT id FROM r) AND e.src <> e.dst GROUP BY 1)
SELECT r.id, round(r.score * CASE WHEN coalesce(a.n, 0) >= 2 THEN 1.05 ELSE 1 END, 6) AS score FROM r LEFT JOIN a USING (id)""")
def graph_signals(spark: SparkSession, folder: str) -> DataFrame:
    """The head of a ranking, raised where its members link to each other."""
    edges = graph.edges(table(spark, folder, "links"))
    degree = edges.groupBy(F.col("dst").alias("id")).agg(F.log(1 + F.count("*").cast("double")).alias("score"))
    head = search.ranked(degree, 20, "id").select("id", "score")
    inside = edges.where("src <> dst").join(F.broadcast(head.select(F.col("id").alias("src"))), "src", "left_semi").join(F.broadcast(head.select(F.col("id").alias("dst"))), "dst", "left_semi")  # twenty rows
    near = inside.groupBy(F.col("dst").alias("id")).agg(F.countDistinct("src").alias("n"))
    return head.join(near, "id", "left").select("id", F.round(F.col("score") * F.when(F.coalesce("n", F.lit(0)) >= 2, 1.05).otherwise(1.0), 6).alias("score"))


@query(f"""WITH i AS (SELECT dst AS id, count(*) AS n FROM {_E} GROUP BY 1) SELECT p.id FROM (SELECT DISTINCT id, updated_at, compiled_truth FROM pages WHERE deleted_at IS NULL) p JOIN i USING (id) WHERE length(coalesce(compiled_truth, '')) < 400 ORDER BY i.n DESC, updated_at DESC NULLS LAST, p.id LIMIT 30""")
def thin_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Short pages that many link to."""
    degree = graph.edges(table(spark, folder, "links")).groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("n"))
    rows = _pages(spark, folder, "updated_at", "deleted_at", F.length(F.coalesce("compiled_truth", F.lit(""))).alias("chars")).where("deleted_at IS NULL AND chars < 400")
    return rows.join(degree, "id").orderBy(F.desc("n"), F.desc_nulls_last("updated_at"), "id").limit(30).select("id")


@query(f"""SELECT id, page_id FROM {_C} c WHERE active AND weight BETWEEN 0.35 AND 0.65 AND EXISTS (SELECT 1 FROM timeline_entries t WHERE t.page_id = c.page_id AND t.date > c.since_date) ORDER BY since_date DESC, id LIMIT 200""")
def claims_to_review(spark: SparkSession, folder: str) -> DataFrame:
    """Open-minded claims with later evidence: the latest day of each page is aggregated before the join."""
    last = table(spark, folder, "timeline_entries").groupBy("page_id").agg(F.max("date").alias("last"))
    rows = derived(spark, folder, "claims").where("active AND weight BETWEEN 0.35 AND 0.65").join(last, "page_id").where("last > since_date")
    return rows.orderBy(F.desc("since_date"), "id").limit(200).select("id", "page_id")


@query("""WITH p AS (SELECT DISTINCT id, slug, created_at FROM pages WHERE NOT starts_with(slug, 'people/')) SELECT split_part(slug, '/', 1) AS prefix, first(id ORDER BY md5('far:' || CAST(id AS VARCHAR)), id) AS id FROM p GROUP BY 1""")
def far_samples(spark: SparkSession, folder: str) -> DataFrame:
    """One page of each prefix but an excluded one, drawn by a seeded hash: a sampling operator."""
    rows = _pages(spark, folder, "slug").where("NOT slug LIKE 'people/%'")
    best = F.min(F.struct(F.md5(F.concat(F.lit("far:"), F.col("id").cast("string"))).alias("h"), "id")).alias("m")
    return rows.groupBy(F.split_part("slug", F.lit("/"), F.lit(1)).alias("prefix")).agg(best).select("prefix", "m.id")


# --- sets and evaluation ----------------------------------------------------------------------------


@query(f"""SELECT 'link' AS kind, count(*) AS n FROM {_E} UNION ALL SELECT 'entry', count(*) FROM (SELECT DISTINCT page_id, date, source, summary FROM timeline_entries) UNION ALL SELECT 'tag', count(*) FROM {_TAGS}""")
def evidence_union(spark: SparkSession, folder: str) -> DataFrame:
    """Three scans, one of a JSON array, as one table."""
    parts = {"link": graph.edges(table(spark, folder, "links")), "entry": table(spark, folder, "timeline_entries").select("page_id", "date", "source", "summary").distinct(), "tag": tag_rows(spark, folder)}
    out = None
    for kind, df in parts.items():
        part = df.select(F.lit(kind).alias("kind"))
        out = part if out is None else out.union(part)
    return out.groupBy("kind").agg(F.count("*").alias("n"))


@query(f"""WITH h AS (SELECT q, doc, row_number() OVER (PARTITION BY q ORDER BY last DESC, doc) AS r FROM (SELECT from_page_id AS q, to_page_id AS doc, max(created_at) AS last FROM links GROUP BY ALL)), g AS (SELECT DISTINCT from_page_id AS q, to_page_id AS doc FROM links WHERE link_type <> 'mentions')
SELECT g.q, CAST(max(CASE WHEN r = 1 THEN 1 ELSE 0 END) AS INT) AS hit1, CAST(max(CASE WHEN r <= 3 THEN 1 ELSE 0 END) AS INT) AS hit3, round(count(h.doc) FILTER (r <= 3) / count(*), 6) AS recall3, round(coalesce(1.0 / min(r), 0), 6) AS reciprocal FROM g LEFT JOIN h ON h.q = g.q AND h.doc = g.doc GROUP BY 1""")
def retrieval_hits(spark: SparkSession, folder: str) -> DataFrame:
    """hit@1, hit@3, recall@3 and the reciprocal rank of a ranking by recency, against typed links as judgements."""
    links = table(spark, folder, "links").select(F.col("from_page_id").alias("q"), F.col("to_page_id").alias("doc"), "link_type", "created_at")
    order = Window.partitionBy("q").orderBy(F.desc("at"), "doc")
    hits = links.groupBy("q", "doc").agg(F.max("created_at").alias("at")).withColumn("r", F.row_number().over(order)).select("q", "doc", "r")
    judged = links.where("link_type <> 'mentions'").select("q", "doc").distinct()
    rows = judged.join(hits, ["q", "doc"], "left")
    flag = lambda k: F.max(F.when(F.col("r") <= k, 1).otherwise(0))
    return rows.groupBy("q").agg(flag(1).alias("hit1"), flag(3).alias("hit3"), F.round(F.count_if(F.col("r") <= 3) / F.count("*"), 6).alias("recall3"), F.round(F.coalesce(1.0 / F.min("r"), F.lit(0.0)), 6).alias("reciprocal"))


@query(f"""WITH a AS (SELECT dst, first(src ORDER BY src) AS top FROM {_E} GROUP BY 1), b AS (SELECT dst, first(src ORDER BY src) AS top FROM {_E} WHERE link_type IS DISTINCT FROM 'mentions' GROUP BY 1) SELECT count(*) AS queries, round(avg(CAST(a.top = b.top AS INT)), 6) AS agreement FROM a JOIN b USING (dst)""")
def run_agreement(spark: SparkSession, folder: str) -> DataFrame:
    """How often two runs have the same first result."""
    edges = graph.edges(table(spark, folder, "links"))
    top = lambda df, name: df.groupBy("dst").agg(F.min("src").alias(name))
    both = top(edges, "a").join(top(edges.where(~F.col("link_type").eqNullSafe("mentions")), "b"), "dst")
    return both.agg(F.count("*").alias("queries"), F.round(F.avg((F.col("a") == F.col("b")).cast("double")), 6).alias("agreement"))


@query(f"""SELECT page_id, round(list_sum(list_transform(range(1, least(n, 3) + 1), lambda i: 1.0)), 0) AS head, CASE WHEN n >= 2 THEN 'listed' ELSE 'single' END AS detail FROM (SELECT page_id, count(*) AS n FROM {_C} GROUP BY 1)""")
def heads_by_intent(spark: SparkSession, folder: str) -> DataFrame:
    """How many rows each page shows, by what it is asked for."""
    out = derived(spark, folder, "claims").groupBy("page_id").agg(F.count("*").alias("n"))
    return out.select("page_id", F.least("n", F.lit(3)).cast("double").alias("head"), F.when(F.col("n") >= 2, "listed").otherwise("single").alias("detail"))


_VEC = "(SELECT DISTINCT page_id, chunk_index, id, CAST(embedding AS DOUBLE[]) AS e FROM content_chunks WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0)"


@query(f"""WITH s AS (SELECT page_id, id, list_cosine_similarity(e, lead(e) OVER w) AS c FROM {_VEC} WINDOW w AS (PARTITION BY page_id ORDER BY chunk_index, id)), q AS (SELECT page_id, quantile_disc(c, 0.2) AS low FROM s WHERE c IS NOT NULL GROUP BY 1)
SELECT s.page_id, s.id, round(greatest(least(1 - c, 2), 0) / 2, 5) AS distance FROM s JOIN q USING (page_id) WHERE c <= low""")
def semantic_boundaries(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks behind which a page turns to something else: the fifth of its steps least alike."""
    fine = "size(embedding) = 64 AND NOT exists(embedding, x -> x IS NULL OR isnan(x) OR abs(x) = float('inf')) AND exists(embedding, x -> x <> 0)"
    rows = table(spark, folder, "content_chunks").where(fine).select("page_id", "chunk_index", "id", "embedding").dropDuplicates(["id"])
    order = Window.partitionBy("page_id").orderBy("chunk_index", "id")
    steps = rows.withColumn("after", F.lead("embedding").over(order)).where("after IS NOT NULL").select("page_id", "id", scores.cosine(F.col("embedding"), F.col("after")).alias("c"))
    low = steps.groupBy("page_id").agg(F.expr("percentile_disc(0.2) WITHIN GROUP (ORDER BY c)").alias("low"))
    return steps.join(low, "page_id").where("c <= low").select("page_id", "id", F.round(strings.distance(F.col("c")), 5).alias("distance"))
