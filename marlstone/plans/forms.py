"""Queries over normal forms, plain text, typed mentions and payloads, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text, unicode
from ..operators import payloads, walks
from ..sources.files import as_markdown
from ..sources.tables import table
from .derived import derived, sql
from .knowledge import _pages
from .registry import query

_CL = sql("claims")


@query(r"""SELECT doc_id, md5(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(text, '(?is)<script\b.*?</script>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '[ \t\n\r\f\x0B]+', ' ', 'g'), '^ +| +$', '', 'g')) AS plain FROM documents WHERE text IS NOT NULL AND NOT regexp_matches(text, '(?i)<style')""")
def html_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Texts without markup. Style blocks are dropped too; no text of these data has one."""
    rows = table(spark, folder, "documents").where(F.col("text").isNotNull() & ~F.col("text").rlike("(?i)<style"))
    return rows.select("doc_id", F.md5(text.plain_text(F.col("text"))).alias("plain"))


@query("""SELECT DISTINCT id, trim(regexp_replace(lower(strip_accents(nfc_normalize(title))), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM pages WHERE title IS NOT NULL AND regexp_matches(title, '^[\\x20-\\x{17F}]*$') AND NOT regexp_matches(title, '[ªº²³¹¼½¾µĳŀŉſĲĿ]')""")
def folded_slugs(spark: SparkSession, folder: str) -> DataFrame:
    """Slugs of titles by their decomposed letters; the SQL knows Latin letters only, so titles of these are compared."""
    rows = _pages(spark, folder, "title").where(F.col("title").rlike("^[\\x20-\\x{17F}]*$") & ~F.col("title").rlike("[ªº²³¹¼½¾µĳŀŉſĲĿ]"))
    return rows.select("id", unicode.slug(F.col("title")).alias("slug"))


@query(r"""SELECT DISTINCT id, regexp_replace(regexp_replace(lower(title), '[ \t\r\n]+', ' ', 'g'), '^[ \[\]{}()"''“”‘’]+|[ \[\]{}()"''“”‘’]+$', '', 'g') AS alias FROM pages WHERE regexp_matches(title, '^[\x20-\x{24F}“”‘’]*$') AND NOT regexp_matches(title, '[\x{A0}¨ª¯²³´µ¸¹º¼½¾Ĳĳ-ĳĿŀŉſǄ-ǌǱ-ǳ]')""")
def folded_aliases(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of aliases in compatibility form; titles that this form would change are left to the unit tests."""
    rows = _pages(spark, folder, "title").where(F.col("title").rlike(r"^[\x20-\x{24F}“”‘’]*$") & ~F.col("title").rlike(r"[\x{A0}¨ª¯²³´µ¸¹º¼½¾Ĳĳ-ĳĿŀŉſǄ-ǌǱ-ǳ]"))
    return rows.select("id", unicode.nfkc(F.col("title")).alias("alias"))


_VERB = "CASE " + " ".join(f"WHEN regexp_matches(lower(s), '{w}') THEN '{k}'" for k, w in walks.VERBS) + " ELSE 'mentions' END"


@query(f"""WITH t AS (SELECT DISTINCT lower(title) AS name, min(id) AS target FROM pages WHERE type = 'company' AND title IS NOT NULL AND length(title) >= 6 GROUP BY 1), s AS (SELECT DISTINCT id, unnest(regexp_split_to_array(compiled_truth, '[.!?\\n]+')) AS s FROM pages WHERE compiled_truth IS NOT NULL)
SELECT DISTINCT s.id AS src, t.target AS dst, {_VERB} AS link_type FROM s JOIN t ON contains(lower(s.s), t.name) WHERE regexp_matches(' ' || array_to_string(regexp_extract_all(lower(s.s), '([\\p{{L}}\\p{{N}}]+)', 1), ' ') || ' ', ' ' || array_to_string(regexp_extract_all(t.name, '([\\p{{L}}\\p{{N}}]+)', 1), ' ') || ' ') AND s.id <> t.target AND len(regexp_extract_all(t.name, '([\\p{{L}}\\p{{N}}]+)', 1)) BETWEEN 2 AND 2""")
def typed_mentions(spark: SparkSession, folder: str) -> DataFrame:
    """Companies of two words that sentences name, with the type that the sentence tells: a dictionary join on pairs of words."""
    words = lambda c: F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}]+)"), 1)
    names = _pages(spark, folder, "title", "type").where("type = 'company' AND length(title) >= 6").select("id", F.lower("title").alias("name"), words(F.col("title")).alias("w")).where("size(w) = 2")
    names = names.groupBy("name", F.array_join("w", " ").alias("run")).agg(F.min("id").alias("dst"))
    parts = table(spark, folder, "pages").where("compiled_truth IS NOT NULL").select(F.col("id").alias("src"), F.explode(F.split("compiled_truth", r"[.!?\n]+")).alias("s")).withColumn("w", words(F.col("s"))).where("size(w) >= 2").distinct()
    runs = F.array_distinct(F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.array_join(F.slice("w", i, 2), " ")))
    said = parts.select("src", "s", F.explode(runs).alias("run"))
    met = said.join(names.hint("merge"), "run").where(F.lower("s").contains(F.col("name")) & (F.col("src") != F.col("dst")))
    return met.select("src", "dst", walks.typed(F.col("s")).alias("link_type")).distinct()


@query(f"SELECT page_id, id, CAST(floor((sum(length(claim)) OVER (PARTITION BY page_id ORDER BY id) - length(claim)) / 200) AS INT) AS \"group\" FROM {_CL}")
def payload_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Claims of each page in groups of a budget of characters."""
    rows = derived(spark, folder, "claims").withColumn("n", F.length("claim"))
    return payloads.grouped(rows, "page_id", "n", 200, "id").select("page_id", "id", "group")


@query("""SELECT DISTINCT slug || '.md' AS path, md5('---' || chr(10) || 'type: ' || coalesce(type, 'concept') || chr(10) || 'title: ' || coalesce(title, '') || chr(10) || '---' || chr(10) || coalesce(compiled_truth, '') || CASE WHEN coalesce(timeline, '') <> '' THEN chr(10) || chr(10) || '<!-- timeline -->' || chr(10) || timeline ELSE '' END) AS body FROM pages""")
def markdown_files(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as markdown files; files are hashed before they are made distinct."""
    return as_markdown(table(spark, folder, "pages")).select("path", F.md5("text").alias("body")).distinct()


@query(f"""SELECT holder, count(*) FILTER (quality = 'correct') AS wins, count(*) AS n, round(count(*) FILTER (quality = 'correct') / nullif(count(*) FILTER (quality IN ('correct', 'incorrect')), 0), 6) AS win_rate FROM {_CL} WHERE quality IS NOT NULL GROUP BY 1""")
def win_rates(spark: SparkSession, folder: str) -> DataFrame:
    rows = derived(spark, folder, "claims").where("quality IS NOT NULL")
    wins, told = F.count_if(F.col("quality") == "correct"), F.count_if(F.col("quality").isin("correct", "incorrect"))
    return rows.groupBy("holder").agg(wins.alias("wins"), F.count("*").alias("n"), F.round(F.when(told > 0, wins / told), 6).alias("win_rate"))


@query(f"""WITH r AS (SELECT kind, domain, avg(CAST(quality = 'correct' AS INT)) AS rate, count(*) AS n FROM {_CL} WHERE quality IN ('correct', 'incorrect') GROUP BY ALL) SELECT kind, round(avg(rate), 6) AS mean, round(coalesce(1 - stddev_samp(rate), 1), 6) AS stability, CAST(sum(n) AS BIGINT) AS n FROM r GROUP BY 1""")
def question_stability(spark: SparkSession, folder: str) -> DataFrame:
    """Mean rates over repeats and how little they differ."""
    rows = derived(spark, folder, "claims").where("quality IN ('correct', 'incorrect')")
    each = rows.groupBy("kind", "domain").agg(F.avg((F.col("quality") == "correct").cast("double")).alias("rate"), F.count("*").alias("n"))
    return each.groupBy("kind").agg(F.round(F.avg("rate"), 6).alias("mean"), F.round(F.coalesce(1 - F.stddev_samp("rate"), F.lit(1.0)), 6).alias("stability"), F.sum("n").alias("n"))
