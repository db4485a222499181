"""Queries over full-text, vector and hybrid search, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scores
from ..operators import fulltext, graph, hybrid, search
from ..session import materialize
from ..sources.tables import table
from .derived import derived, sql
from .knowledge import _E, _LIVE, NOW, _chunks, _live, _pages
from .registry import query
from .texts import _factor_sql

ASKED = "weekly budgets"
_FACTOR = f"CAST({_factor_sql('p.slug')} AS DOUBLE)"
_STEMS = fulltext.stem_sql("chunk_text")
_CT = "(SELECT DISTINCT id, page_id, chunk_text, chunk_source FROM content_chunks)"


def _rank_sql(words: list[str], field: str, weight: str) -> str:
    n = lambda w: f"CAST(len(list_filter({field}, lambda x: x = '{w}')) AS DOUBLE)"
    return " + ".join(f"{fulltext.WEIGHTS[weight]} * {n(w)} / ({n(w)} + 1)" for w in words)


_ASKED = fulltext.parse(ASKED).words
_HITS = f"""(SELECT id, page_id, chunk_source, ({_rank_sql(_ASKED, 's', 'B')}) / {len(_ASKED)} AS score FROM (SELECT id, page_id, chunk_source, {_STEMS} AS s FROM {_CT}) WHERE {" AND ".join(f"list_contains(s, '{w}')" for w in _ASKED)})"""
_KARM = f"""(SELECT page_id, chunk_id, truth, score, row_number() OVER (ORDER BY score DESC, page_id) - 1 AS rank FROM (SELECT h.page_id, h.id AS chunk_id, h.chunk_source IS NOT DISTINCT FROM 'compiled_truth' AS truth, h.score * {_FACTOR} AS score,
row_number() OVER (PARTITION BY h.page_id ORDER BY h.score * {_FACTOR} DESC, h.id) AS n FROM {_HITS} h JOIN {_LIVE} p ON p.id = h.page_id) WHERE n = 1 QUALIFY rank < 60)"""
_V = "(SELECT DISTINCT id, page_id, chunk_source, CAST(embedding AS DOUBLE[]) AS e FROM content_chunks WHERE len(embedding) = 64 AND model = 'embed-large-v3' AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0)"
_VARM = f"""(SELECT page_id, chunk_id, truth, raw, score, row_number() OVER (ORDER BY score DESC, page_id) - 1 AS rank FROM (SELECT v.page_id, v.id AS chunk_id, v.chunk_source IS NOT DISTINCT FROM 'compiled_truth' AS truth, c AS raw, c * {_FACTOR} AS score,
row_number() OVER (PARTITION BY v.page_id ORDER BY c * {_FACTOR} DESC, v.id) AS n FROM (SELECT v.*, list_cosine_similarity(v.e, q.e) AS c FROM {_V} v, (SELECT e FROM {_V} ORDER BY id LIMIT 1) q) v JOIN {_LIVE} p ON p.id = v.page_id) WHERE n = 1 QUALIFY rank < 60)"""
_FUSED = f"""(SELECT page_id, t / max(t) OVER () * CASE WHEN truth THEN 2.0 ELSE 1.0 END AS score FROM (SELECT page_id, sum(1 / (60.0 + rank)) AS t, first(truth ORDER BY n) AS truth FROM (SELECT page_id, truth, rank, 0 AS n FROM {_KARM} UNION ALL SELECT page_id, truth, rank, 1 FROM {_VARM}) GROUP BY 1))"""


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Usable vectors of one model, one row a chunk."""
    fine = "size(embedding) = 64 AND model = 'embed-large-v3' AND NOT exists(embedding, x -> x IS NULL OR isnan(x) OR abs(x) = float('inf')) AND exists(embedding, x -> x <> 0)"
    return table(spark, folder, "content_chunks").where(fine).select("id", "page_id", "chunk_source", "embedding").dropDuplicates(["id"])


def _asked(vectors: DataFrame) -> list[float]:
    """The vector of the query: here that of the first chunk, one row."""
    first = vectors.orderBy("id").select("embedding").first()
    return [float(x) for x in first[0]] if first else [1.0]


def _arms(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    live = _live(spark, folder).select("id", "slug").distinct()
    vectors = _vectors(spark, folder)
    return hybrid.keyword_arm(_chunks(spark, folder, "page_id", "chunk_text", "chunk_source"), live, ASKED), hybrid.vector_arm(vectors, live, _asked(vectors))


@query(f"""SELECT id, page_id, round(score, 6) AS score FROM {_HITS}""")
def fulltext_search(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks that hold all words of a query by their stems."""
    found = fulltext.search(_chunks(spark, folder, "page_id", "chunk_text"), ASKED, {"chunk_text": "B"})
    return found.select("id", "page_id", F.round("rank", 6).alias("score"))


_PHRASE = 'budget or runway "open question" -harvest'


@query(f"""SELECT id FROM (SELECT DISTINCT id, {fulltext.stem_sql("compiled_truth")} AS s FROM pages) WHERE (list_contains(s, 'budget') OR list_contains(s, 'runway'))
AND contains(' ' || array_to_string(s, ' ') || ' ', ' {" ".join(fulltext.parse(_PHRASE).phrases[0])} ') AND NOT list_contains(s, '{fulltext.parse(_PHRASE).without[0]}')""")
def phrase_search(spark: SparkSession, folder: str) -> DataFrame:
    """Alternatives, a phrase and an exclusion."""
    return fulltext.search(_pages(spark, folder, "compiled_truth"), _PHRASE, {"compiled_truth": "B"}).select("id")


@query(f"SELECT id, round(score, 6) AS score FROM {_HITS}")
def indexed_search(spark: SparkSession, folder: str) -> DataFrame:
    """The same chunks from an inverted index that is written first."""
    index = materialize(fulltext.postings(_chunks(spark, folder, "chunk_text"), "id", {"chunk_text": "B"}))
    return fulltext.search_postings(index, "id", ASKED).select("id", F.round("rank", 6).alias("score"))


@query(f"""SELECT id FROM (SELECT DISTINCT id, {fulltext.stem_sql("compiled_truth")} AS s FROM pages) WHERE (list_contains(s, 'budget') OR list_contains(s, 'runway'))
AND contains(' ' || array_to_string(s, ' ') || ' ', ' {" ".join(fulltext.parse(_PHRASE).phrases[0])} ') AND NOT list_contains(s, '{fulltext.parse(_PHRASE).without[0]}')""")
def indexed_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """Alternatives, a phrase and an exclusion from the positions of an index."""
    index = fulltext.postings(_pages(spark, folder, "compiled_truth"), "id", {"compiled_truth": "B"})
    return fulltext.search_postings(index, "id", _PHRASE).select("id")


_W = fulltext.parse("weekly review").words


@query(f"""SELECT id, round(({_rank_sql(_W, 'a', 'A')} + {_rank_sql(_W, 'b', 'B')} + {_rank_sql(_W, 'c', 'C')}) / {len(_W)}, 6) AS rank FROM (SELECT DISTINCT id, {fulltext.stem_sql("title")} AS a, {fulltext.stem_sql("compiled_truth")} AS b, {fulltext.stem_sql("timeline")} AS c FROM pages)
WHERE {" AND ".join(f"list_contains(a || b || c, '{w}')" for w in _W)}""")
def page_fulltext(spark: SparkSession, folder: str) -> DataFrame:
    """Whole pages: title, body and timeline weigh differently."""
    found = fulltext.search(_pages(spark, folder, "title", "compiled_truth", "timeline"), "weekly review", {"title": "A", "compiled_truth": "B", "timeline": "C"})
    return found.select("id", F.round("rank", 6).alias("rank"))


_M = fulltext.parse("migration").words


@query(f"""SELECT id, round({_rank_sql(_M, 'a', 'A')} + {_rank_sql(_M, 'b', 'A')} + {_rank_sql(_M, 'c', 'B')}, 6) AS rank FROM (SELECT DISTINCT id, {fulltext.stem_sql("doc_comment")} AS a, {fulltext.stem_sql("symbol_name_qualified")} AS b, {_STEMS} AS c FROM content_chunks WHERE language IS NOT NULL)
WHERE list_contains(a || b || c, '{_M[0]}')""")
def code_fulltext(spark: SparkSession, folder: str) -> DataFrame:
    """Code chunks: remarks and symbols weigh more than the text."""
    rows = table(spark, folder, "content_chunks").where("language IS NOT NULL").select("id", "doc_comment", "symbol_name_qualified", "chunk_text").distinct()
    return fulltext.search(rows, "migration", {"doc_comment": "A", "symbol_name_qualified": "A", "chunk_text": "B"}).select("id", F.round("rank", 6).alias("rank"))


@query(f"SELECT page_id, chunk_id, round(raw, 5) AS cosine, rank FROM {_VARM}")
def vector_search(spark: SparkSession, folder: str) -> DataFrame:
    """Pages by their chunk most similar to a query vector, weighed by the prefix of their slug."""
    return _arms(spark, folder)[1].select("page_id", "chunk_id", F.round("raw", 5).alias("cosine"), "rank")


@query(f"SELECT page_id, round(score, 6) AS score FROM {_FUSED}")
def fused_search(spark: SparkSession, folder: str) -> DataFrame:
    """Keyword and vector arms fused by reciprocal rank."""
    return hybrid.fused(_arms(spark, folder)).select("page_id", F.round("score", 6).alias("score"))


_FULL = f"""(SELECT f.page_id, CASE WHEN v.raw IS NULL THEN f.score ELSE 0.7 * f.score / max(f.score) OVER () + 0.3 * v.raw END AS score FROM {_FUSED} f LEFT JOIN {_VARM} v USING (page_id))"""


@query(f"""WITH r AS {_FULL}, b AS (SELECT dst AS page_id, count(*) AS n FROM {_E} WHERE link_type IS DISTINCT FROM 'mentions' GROUP BY 1)
SELECT r.page_id, round(r.score * (1 + 0.05 * ln(1 + coalesce(b.n, 0))) * (1 + 0.15 * ln(1 + greatest(coalesce(CAST(p.emotional_weight AS DOUBLE), 0) * 5, 0))) * (1 + 0.3 * 30 / (30 + greatest((epoch_us(TIMESTAMP '{NOW}') - epoch_us(coalesce(p.updated_at, p.created_at))) / 86400000000.0, 0)))
* CASE WHEN contains(lower(p.title), 'budget') THEN 1.25 ELSE 1 END, 6) AS score FROM r JOIN (SELECT DISTINCT id AS page_id, title, emotional_weight, updated_at, created_at FROM pages) p USING (page_id) LEFT JOIN b USING (page_id)""")
def hybrid_full(spark: SparkSession, folder: str) -> DataFrame:
    """Both arms fused, rescored by cosine, with backlink, salience, recency and title boosts."""
    arms = _arms(spark, folder)
    rows = hybrid.rescored(hybrid.fused(arms), arms[1])
    links = graph.edges(table(spark, folder, "links")).where(~F.col("link_type").eqNullSafe("mentions")).groupBy(F.col("dst").alias("page_id")).agg(F.count("*").alias("n"))
    pages = _pages(spark, folder, "title", "emotional_weight", "updated_at", "created_at").withColumnRenamed("id", "page_id")
    both = rows.join(pages, "page_id").join(links, "page_id", "left")
    weight = F.greatest(F.coalesce(F.col("emotional_weight").cast("double"), F.lit(0.0)) * 5, F.lit(0.0))
    age = scores.age_days(F.coalesce("updated_at", "created_at"), NOW)
    score = F.col("score") * scores.backlink_boost(F.coalesce("n", F.lit(0))) * (1 + 0.15 * F.log(1 + weight)) * (1 + scores.hyperbolic(age, 30.0, 0.3)) * F.when(F.lower("title").contains("budget"), 1.25).otherwise(1.0)
    return both.select("page_id", F.round(score, 6).alias("score"))


_WORDS = "list_distinct(regexp_extract_all(lower(coalesce(chunk_text, '')), '([a-z0-9]+)', 1))"


@query(f"""WITH RECURSIVE h AS (SELECT h.id, h.page_id, p.type, h.chunk_source IS NOT DISTINCT FROM 'compiled_truth' AS truth, h.score, {_WORDS} AS w FROM {_HITS} h JOIN {_LIVE} p ON p.id = h.page_id JOIN {_CT} c ON c.id = h.id ORDER BY h.score DESC, h.id LIMIT 60),
a AS (SELECT *, row_number() OVER (ORDER BY score DESC, id) AS pos FROM h QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY score DESC, id) <= 3), o AS (SELECT *, row_number() OVER (ORDER BY pos) AS at FROM a),
x AS (SELECT i.at, list(j.at) FILTER (j.at IS NOT NULL) AS bad FROM o i LEFT JOIN o j ON j.at < i.at AND len(list_intersect(i.w, j.w)) > 0.85 * len(list_distinct(i.w || j.w)) GROUP BY 1),
g AS (SELECT CAST(0 AS BIGINT) AS at, CAST([] AS BIGINT[]) AS kept UNION ALL SELECT x.at, CASE WHEN list_has_any(coalesce(x.bad, []), g.kept) THEN g.kept ELSE list_append(g.kept, x.at) END FROM g JOIN x ON x.at = g.at + 1),
b AS (SELECT o.* FROM o WHERE list_contains((SELECT kept FROM g ORDER BY g.at DESC LIMIT 1), o.at)), c AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY type ORDER BY score DESC, id) <= ceil((SELECT count(*) FROM b) * 0.6)),
d AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY score DESC, id) <= 2), l AS (SELECT page_id, first(id ORDER BY score, id DESC) AS low FROM d GROUP BY 1 HAVING NOT bool_or(truth)), t AS (SELECT page_id, first(id ORDER BY score DESC, id) AS best FROM h WHERE truth GROUP BY 1)
SELECT d.page_id, CASE WHEN l.low = d.id AND t.best IS NOT NULL THEN t.best ELSE d.id END AS id FROM d LEFT JOIN l USING (page_id) LEFT JOIN t USING (page_id)""")
def dedup_layers(spark: SparkSession, folder: str) -> DataFrame:
    """All five layers over the best chunks of a query."""
    chunks = _chunks(spark, folder, "page_id", "chunk_text", "chunk_source")
    hits = fulltext.search(chunks, ASKED, {"chunk_text": "B"}).withColumnRenamed("rank", "score").withColumn("truth", F.col("chunk_source").eqNullSafe("compiled_truth"))
    rows = hits.join(_live(spark, folder).select(F.col("id").alias("page_id"), "type").distinct(), "page_id")
    return hybrid.deduplicated(rows.select("id", "page_id", "type", "truth", "score", "chunk_text"), "chunk_text", 60).select("page_id", "id")


@query(f"""WITH k AS (SELECT id, row_number() OVER (ORDER BY weight DESC, id) AS r FROM {sql('claims')} WHERE contains(lower(claim), 'order') QUALIFY r <= 30), t AS (SELECT id, row_number() OVER (ORDER BY since_date DESC, id) AS r FROM {sql('claims')} WHERE active AND contains(lower(claim), 'order') QUALIFY r <= 30)
SELECT id, round(sum(1 / (60.0 + r)), 8) AS score FROM (SELECT * FROM k UNION ALL SELECT * FROM t) GROUP BY 1""")
def claim_gather(spark: SparkSession, folder: str) -> DataFrame:
    """Two streams of claims fused by ranks that count from one."""
    rows = derived(spark, folder, "claims").where("contains(lower(claim), 'order')")
    by = lambda df, *order: search.ranked(df.withColumn("score", order[0]), 30, "id").select("id", (F.col("rank") + 1).alias("r"))
    both = by(rows, F.col("weight")).union(by(rows.where("active"), F.unix_date("since_date")))
    return both.groupBy("id").agg(F.round(F.sum(1 / (60.0 + F.col("r"))), 8).alias("score"))


@query(f"""WITH q AS (SELECT list_distinct(flatten(list_transform(['purchase', 'order'], lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3))))) AS g),
t AS (SELECT id, holder, list_distinct(flatten(list_transform(list_filter(string_split(regexp_replace(lower(claim), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3))))) AS g FROM {sql('claims')} WHERE holder IN ('holder-1', 'holder-2'))
SELECT id, round(len(list_intersect(t.g, q.g)) / len(list_distinct(t.g || q.g)), 6) AS score FROM t, q WHERE len(list_intersect(t.g, q.g)) / len(list_distinct(t.g || q.g)) >= 0.1""")
def claim_search(spark: SparkSession, folder: str) -> DataFrame:
    """Claims of allowed holders by trigrams."""
    from ..functions import text

    rows = derived(spark, folder, "claims").where("holder IN ('holder-1', 'holder-2')").withColumn("s", text.similarity(F.col("claim"), F.lit("purchase order")))
    return rows.where("s >= 0.1").select("id", F.round("s", 6).alias("score"))


@query(f"""WITH s AS (SELECT page_id, score, row_number() OVER (ORDER BY score DESC, page_id) AS r FROM {_FULL}) SELECT page_id, CASE WHEN score >= 0.85 THEN 'strong' WHEN score >= 0.6 THEN 'fair' ELSE 'weak' END AS evidence, CASE WHEN score >= 0.85 THEN 'exists' WHEN score >= 0.6 THEN 'probable' ELSE 'unknown' END AS verdict, score >= (SELECT max(score) FROM s) * 0.5 AS above_gate FROM s""")
def evidence_classes(spark: SparkSession, folder: str) -> DataFrame:
    """Each result's class of evidence by floors of its score, and whether it passes a gate relative to the best."""
    from pyspark.sql import Window

    arms = _arms(spark, folder)
    rows = hybrid.rescored(hybrid.fused(arms), arms[1])
    named = lambda a, b, c: F.when(F.col("score") >= 0.85, a).when(F.col("score") >= 0.6, b).otherwise(c)
    gate = F.col("score") >= F.max("score").over(Window.partitionBy(F.lit(0))) * 0.5
    return rows.select("page_id", named("strong", "fair", "weak").alias("evidence"), named("exists", "probable", "unknown").alias("verdict"), gate.alias("above_gate"))
