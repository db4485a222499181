"""Queries over chat logs, fences, chunkers and caches, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import chats, chunkers, fences, pages as page_ops, writes
from ..session import materialize
from ..sources.tables import table
from .derived import derived, sql
from .knowledge import NOW, _chunks
from .registry import query

_L = "(SELECT doc_id, generate_subscripts(l, 1) AS n, unnest(l) AS line FROM (SELECT doc_id, regexp_split_to_array(text, '\\r?\\n') AS l FROM documents WHERE text IS NOT NULL))"


def _lit(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


_MARKS = ", ".join(f"CAST(regexp_matches(line, {_lit(s.pattern)}) AS INT) AS m{i}" for i, s in enumerate(chats.SHAPES))
_HEADS = ", ".join(f"sum(CASE WHEN pos <= {chats.HEAD} THEN m{i} ELSE 0 END) / least(count(*), {chats.HEAD}) AS h{i}, sum(m{i}) / count(*) AS a{i}" for i in range(len(chats.SHAPES)))
_N = len(chats.SHAPES)


def _first(of: str) -> str:
    best = f"greatest({', '.join(f'{of}{i}' for i in range(_N))})"
    return f"CASE {' '.join(f'WHEN {of}{i} = {best} THEN {i}' for i in range(_N))} END", best


_SHAPE = f"""(SELECT doc_id, CASE WHEN {_first('h')[1]} >= {chats.FEW} THEN {_first('h')[0]} WHEN {_first('a')[1]} >= {chats.LEAST} THEN {_first('a')[0]} END AS shape, CASE WHEN {_first('h')[1]} >= {chats.FEW} THEN {_first('h')[1]} ELSE {_first('a')[1]} END AS score FROM
(SELECT doc_id, {_HEADS} FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS pos, {_MARKS} FROM {_L} WHERE regexp_matches(line, '[^ \\t\\n\\f\\r\\x0B]')) GROUP BY 1))"""


@query(f"SELECT doc_id, shape, round(score, 6) AS score FROM {_SHAPE}")
def chat_shapes(spark: SparkSession, folder: str) -> DataFrame:
    """The chat format of every document, chosen by the share of lines that have it; most have none."""
    return chats.scores(table(spark, folder, "documents"), "doc_id", "text").select("doc_id", "shape", F.round("score", 6).alias("score"))


def _pick(which: str) -> str:
    return "CASE shape " + " ".join(f"WHEN {i} THEN regexp_extract(line, {_lit(s.pattern)}, {getattr(s, which)})" for i, s in enumerate(chats.SHAPES) if getattr(s, which)) + " END"


_BEGINS = "CASE shape " + " ".join(f"WHEN {i} THEN regexp_matches(line, {_lit(s.pattern)})" for i, s in enumerate(chats.SHAPES)) + " ELSE false END"


@query(rf"""WITH r AS (SELECT l.*, s.shape, {_BEGINS} AS begins FROM {_L} l JOIN {_SHAPE} s USING (doc_id) WHERE shape IS NOT NULL), t AS (SELECT *, sum(CAST(begins AS INT)) OVER (PARTITION BY doc_id ORDER BY n) AS turn FROM r),
g AS (SELECT doc_id, shape, CAST(turn AS BIGINT) AS turn, first(line ORDER BY n) AS line, string_agg(CASE WHEN begins THEN coalesce({_pick('text')}, '') ELSE line END, chr(10) ORDER BY n) AS said FROM t WHERE turn > 0 GROUP BY ALL)
SELECT doc_id, turn, CAST(CASE upper({_pick('half')}) WHEN 'PM' THEN h % 12 + 12 WHEN 'AM' THEN h % 12 ELSE h END AS INT) AS hour, coalesce(nullif(trim(regexp_replace({_pick('speaker')}, '^[^\p{{L}}\p{{N}}]+', '')), ''), {_pick('speaker')}) AS speaker, md5(regexp_replace(said, '^[ \t\n\f\r\x0B]+|[ \t\n\f\r\x0B]+$', '', 'g')) AS said
FROM (SELECT *, try_cast({_pick('hour')} AS INT) AS h FROM g)""")
def chat_messages(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with a chat format as turns: hour, speaker and what was said, over its lines."""
    found = chats.turns(table(spark, folder, "documents"), "doc_id", "text")
    return found.select("doc_id", "turn", "hour", "speaker", F.md5("said").alias("said"))


HEADS = "| # | claim | kind | weight |"
_CL = sql("claims")


def _fenced(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, text): each page's claims as a fence in a text."""
    claims = derived(spark, folder, "claims").withColumn("claim", F.regexp_replace("claim", r"[\r\n]", " "))
    line = fences.line_of(F.col("row_num"), F.col("claim"), F.col("kind"), F.col("weight"))
    per_page = claims.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("row_num", line.alias("line")))).alias("l"))
    fence = fences.fence_of(F.transform("l", lambda x: x["line"]), "claims", HEADS)
    return per_page.select("page_id", F.concat(F.lit("# Page\n\nBefore.\n\n"), fence, F.lit("\n\nBehind.")).alias("text"), F.size("l").alias("rows"))


@query(f"SELECT page_id, row_num, md5(trim(regexp_replace(claim, '[\\r\\n]', ' ', 'g'))) AS claim, kind, true AS active FROM {_CL}")
def fence_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Claims written into fences and read back."""
    found = fences.rows(_fenced(spark, folder), "page_id", "text", "claims")
    return found.select("page_id", "row_num", F.md5(F.col("cells")[0]).alias("claim"), F.col("cells")[1].alias("kind"), "active")


@query(f"""WITH c AS (SELECT page_id, row_num, kind, max(row_num) OVER (PARTITION BY page_id) AS last FROM {_CL}) SELECT page_id, row_num, kind, row_num <> 1 AS active FROM c UNION ALL SELECT DISTINCT page_id, last + 1, 'new', true FROM c""")
def superseded_fence_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The first row of each fence struck, and one added, twice: the second time changes nothing."""
    pages = _fenced(spark, folder)
    new = F.col("rows") + 1
    for _ in range(2):
        pages = pages.withColumn("text", fences.superseded(F.col("text"), "claims", F.lit(1), new, fences.line_of(new, F.lit("a | b $1"), F.lit("new"), F.lit(0.5))))
    found = fences.rows(pages, "page_id", "text", "claims")
    return found.select("page_id", "row_num", F.col("cells")[1].alias("kind"), "active")


@query(f"""SELECT page_id, count(*) + 1 AS rows, true AS kept FROM {_CL} GROUP BY 1""")
def appended_table_rows(spark: SparkSession, folder: str) -> DataFrame:
    """A row appended to the table of a section, which is made where it is missing."""
    pages = _fenced(spark, folder)
    line = F.array(F.lit("| x | $2 | y |"))
    once = pages.withColumn("text", fences.appended(F.col("text"), "Tracker", line))
    twice = once.withColumn("more", fences.appended(F.col("text"), "Tracker", line))
    count = F.regexp_count("more", F.lit(r"\| x \| \$2 \| y \|\n"))
    return twice.select("page_id", (F.col("rows") + count - 1).cast("bigint").alias("rows"), F.startswith("more", "text").alias("kept"))


# --- chunkers ---------------------------------------------------------------------------------------


@query(r"""SELECT count(*) AS texts, CAST(sum(w) AS BIGINT) AS words, CAST(0 AS BIGINT) AS long FROM (SELECT doc_id, len(list_filter(regexp_split_to_array(text, '[ \t\n\r\x0B\f\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+'), lambda x: x <> '')) AS w FROM documents WHERE text IS NOT NULL AND length(text) < 6000) WHERE w > 0""")
def recursive_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold of recursive chunks: every word stands once outside the overlaps, no chunk is too long.

    Texts of 6,000 characters and more are cut by characters where they have no blanks, so words are counted in shorter ones.
    """
    rows = table(spark, folder, "documents").where("length(text) < 6000")
    made = chunkers.chunked(rows, "doc_id", "text")
    n = F.size(F.filter(F.split("chunk_text", r"[\s\x1c-\x1f\x85\xa0  -     　]+"), lambda w: w != "")) - F.col("lead")
    return made.agg(F.countDistinct("doc_id").alias("texts"), F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("words"), F.count_if(n > 450).alias("long"))


@query(r"""SELECT DISTINCT id, regexp_extract(line, '^(?:export[ ]+)?(?:async[ ]+)?(?:def|func|function|class)[ ]+(\w+)', 1) AS name, n AS first_line FROM (SELECT id, generate_subscripts(l, 1) AS n, unnest(l) AS line FROM (SELECT DISTINCT id, string_split(chunk_text, chr(10)) AS l FROM content_chunks WHERE language IS NOT NULL))
WHERE regexp_matches(line, '^(?:export[ ]+)?(?:async[ ]+)?(?:def|func|function|class)[ ]+(\w+)')""")
def code_symbols(spark: SparkSession, folder: str) -> DataFrame:
    """The top-level symbols of code chunks: of Python by its syntax tree."""
    rows = _chunks(spark, folder, "chunk_text", "language").where("language IS NOT NULL")
    return chunkers.symbol_rows(rows, "id", "chunk_text", "language").select("id", "name", "first_line")


# --- caches -----------------------------------------------------------------------------------------

_CAP = sql("captured")


@query(f"""WITH c AS (SELECT query AS key, max(created_at) AS written FROM {_CAP} WHERE tool = 'view' OR tool = 'click' GROUP BY 1) SELECT count(*) AS entries, count(*) FILTER (written + INTERVAL 1 DAY > TIMESTAMP '2024-01-20') AS fresh FROM c""")
def cache_states(spark: SparkSession, folder: str) -> DataFrame:
    """A cache by key after all its writes, and how many entries still hold at a moment."""
    rows = derived(spark, folder, "captured").where("tool IN ('view', 'click')").select(F.col("query").alias("key"), F.col("created_at").alias("at"))
    cache = rows.groupBy("key").agg(F.max("at").alias("at"))
    return cache.agg(F.count("*").alias("entries"), F.count_if(F.col("at") + F.expr("INTERVAL 1 DAY") > F.to_timestamp_ntz(F.lit("2024-01-20"))).alias("fresh"))


@query("""WITH k AS (SELECT DISTINCT id, generation, id % 3 AS kind FROM pages) SELECT id, CASE kind WHEN 0 THEN 'hit' WHEN 1 THEN 'stale' ELSE 'expired' END AS state FROM k""")
def cache_freshness(spark: SparkSession, folder: str) -> DataFrame:
    """Cached results hold while they are young and their pages' generations are those they were made from.

    The generations kept with each entry are a map; it is exploded and met by the pages of now.
    """
    pages = table(spark, folder, "pages").select("id", "generation").distinct()
    now = F.to_timestamp_ntz(F.lit(NOW))
    kept = pages.select(
        F.col("id").alias("entry"), F.when(F.col("id") % 3 == 2, now - F.expr("INTERVAL 2 DAY")).otherwise(now).alias("at"),
        F.create_map(F.col("id"), F.col("generation") + F.when(F.col("id") % 3 == 1, 1).otherwise(0)).alias("made_from"),
    )
    each = kept.select("entry", "at", F.explode("made_from").alias("id", "then"))
    met = each.join(pages, "id", "left").groupBy("entry", "at").agg(F.max((~F.col("then").eqNullSafe(F.col("generation"))).cast("int")).alias("off"))
    state = F.when(F.col("at") < now - F.expr("INTERVAL 1 DAY"), "expired").when(F.col("off") == 1, "stale").otherwise("hit")
    return met.select(F.col("entry").alias("id"), state.alias("state"))


@query(f"""SELECT id FROM {_CAP} WHERE id % 4 <> 0""")
def pending_keys(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of a run that stopped: all keys but the completed ones, which a table keeps."""
    rows = derived(spark, folder, "captured").select("id")
    done = materialize(rows.where("id % 4 = 0"))
    return writes.deleted(rows, done, ["id"])


@query("""SELECT p.id, coalesce(v.path, 'none') AS verdict FROM (SELECT DISTINCT id, content_hash FROM pages) p LEFT JOIN (SELECT DISTINCT id, 'known' AS path, content_hash FROM pages WHERE id % 2 = 0 AND content_hash IS NOT NULL) v ON v.id = p.id AND v.content_hash = p.content_hash""")
def verdict_cache(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts kept by (path, hash): a changed hash has none."""
    pages = table(spark, folder, "pages").select("id", "content_hash").distinct()
    kept = page_ops.insert_ignore(spark.createDataFrame([], "id int, content_hash string, verdict string"), pages.where("id % 2 = 0 AND content_hash IS NOT NULL").withColumn("verdict", F.lit("known")), ["id", "content_hash"])
    return pages.join(kept, ["id", "content_hash"], "left").select("id", F.coalesce("verdict", F.lit("none")).alias("verdict"))
