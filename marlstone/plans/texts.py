"""Queries over text functions, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import strings
from ..operators import documents
from ..sources.tables import table
from .derived import derived, sql
from .knowledge import NOW, _chunks, _pages
from .registry import query

_D = "(SELECT doc_id, text FROM documents WHERE text IS NOT NULL)"


def _docs(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return table(spark, folder, "documents").where("text IS NOT NULL").select("doc_id", "text", *columns)


@query(r"SELECT doc_id, regexp_replace(title, '([%_\\])', '\\\1', 'g') AS escaped FROM documents WHERE title IS NOT NULL")
def escaped_titles(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").where("title IS NOT NULL")
    return rows.select("doc_id", strings.like_escaped(F.col("title")).alias("escaped"))


def _factor_sql(column: str) -> str:
    return "CASE " + " ".join(f"WHEN starts_with({column}, '{p}') THEN {f}" for p, f in sorted(strings.PREFIX_FACTORS.items(), key=lambda x: -len(x[0]))) + " ELSE 1.0 END"


@query(f"SELECT DISTINCT id, CAST({_factor_sql('slug')} AS DOUBLE) AS factor, CASE WHEN {_factor_sql('slug')} > 1.05 THEN 'boosted' WHEN {_factor_sql('slug')} < 0.95 THEN 'demoted' ELSE 'plain' END AS tier FROM pages WHERE NOT (starts_with(slug, 'test/') OR starts_with(slug, 'attachments/') OR starts_with(slug, '.raw/'))")
def source_factors(spark: SparkSession, folder: str) -> DataFrame:
    """The factor of each page by the longest prefix of its slug, and its tier; hidden prefixes are left out."""
    factor = strings.prefix_factor(F.col("slug"))
    tier = F.when(factor > 1.05, "boosted").when(factor < 0.95, "demoted").otherwise("plain")
    return _pages(spark, folder, "slug").where(~strings.hidden(F.col("slug"))).select("id", factor.alias("factor"), tier.alias("tier"))


_DECAY = {"meetings/": (30.0, 0.3), "notes/": (90.0, 0.2), "people/": (0.0, 0.0)}


@query(f"""SELECT DISTINCT id, round(CASE WHEN starts_with(slug, 'meetings/') THEN 0.3 * 30 / (30 + age) WHEN starts_with(slug, 'notes/') THEN 0.2 * 90 / (90 + age) WHEN starts_with(slug, 'people/') THEN 0 ELSE 0.1 * 60 / (60 + age) END, 6) AS recency
FROM (SELECT *, greatest((epoch_us(TIMESTAMP '{NOW}') - epoch_us(coalesce(effective_date, updated_at, created_at))) / 86400000000.0, 0) AS age FROM pages)""")
def prefix_recency(spark: SparkSession, folder: str) -> DataFrame:
    """Hyperbolic decay with a half-life for each prefix; evergreen prefixes have none."""
    age = F.greatest((F.unix_micros(F.lit(NOW).cast("timestamp")) - F.unix_micros(F.coalesce("effective_date", "updated_at", "created_at").cast("timestamp"))) / 86_400_000_000, F.lit(0.0))
    out = F.lit(0.1) * 60 / (60 + age)
    for prefix, (half, weight) in _DECAY.items():
        out = F.when(F.col("slug").startswith(prefix), F.lit(weight) * half / (half + age) if half else F.lit(0.0)).otherwise(out)
    return _pages(spark, folder, "slug", "effective_date", "updated_at", "created_at").select("id", F.round(out, 6).alias("recency"))


@query(rf"""SELECT doc_id, length(text) AS chars, md5(list_reduce(list_prepend(f, regexp_extract_all(f, '(`[^`\n]+`)', 1)), lambda s, x: replace(s, x, repeat(' ', length(x))))) AS masked FROM
(SELECT doc_id, text, list_reduce(list_prepend(text, regexp_extract_all(text, '(?s)(```.*?(?:```|\z))', 1)), lambda s, x: replace(s, x, repeat(' ', length(x)))) AS f FROM {_D})""")
def masked_code(spark: SparkSession, folder: str) -> DataFrame:
    """Texts with their code as blanks of the same length."""
    return _docs(spark, folder).select("doc_id", F.length("text").alias("chars"), F.md5(strings.masked_code(F.col("text"))).alias("masked"))


@query(rf"""SELECT doc_id, round(CASE WHEN length(text) > 0 THEN 1 - length(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '(?s)```.*?```', '', 'g'), '!\[[^\]]*\]\([^)]*\)', '', 'g'), '\[([^\]]*)\]\([^)]*\)', '\1', 'g'), '\[\[([^\]]*)\]\]', '\1', 'g'), '<[^>]+>', '', 'g'), '[#*_>`|-]', '', 'g')) / length(text) ELSE 0 END, 6) AS ratio FROM {_D}""")
def markup_ratios(spark: SparkSession, folder: str) -> DataFrame:
    return _docs(spark, folder).select("doc_id", F.round(strings.markup_ratio(F.col("text")), 6).alias("ratio"))


@query(f"SELECT page_id, row_num, floor(least(greatest(weight * 1.3 - 0.1, 0), 1) * 20 + 0.5) / 20 AS weight FROM {sql('claims')}")
def rounded_weights(spark: SparkSession, folder: str) -> DataFrame:
    rows = derived(spark, folder, "claims")
    return rows.select("page_id", "row_num", strings.rounded_weight(F.col("weight") * 1.3 - 0.1).alias("weight"))


_LUHN = """list_sum(list_transform(range(1, length(d) + 1), lambda i: CASE WHEN i % 2 = 1 THEN CAST(substr(reverse(d), i, 1) AS INT) ELSE (CAST(substr(reverse(d), i, 1) AS INT) * 2) // 10 + (CAST(substr(reverse(d), i, 1) AS INT) * 2) % 10 END)) % 10 = 0"""


@query(rf"SELECT doc_id, d AS digits, {_LUHN} AS valid FROM (SELECT DISTINCT doc_id, regexp_replace(unnest(regexp_extract_all(text, '\b(\d(?:[ -]?\d){{9,18}})\b', 1)), '[ -]', '', 'g') AS d FROM {_D})")
def card_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Long runs of digits and whether their check digit holds."""
    found = _docs(spark, folder).select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"\b(\d(?:[ -]?\d){9,18})\b"), 1)).alias("x"))
    return found.select("doc_id", F.regexp_replace("x", "[ -]", "").alias("digits")).distinct().withColumn("valid", F.call_function("luhn_check", "digits"))


_SCRUB = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}', '[EMAIL]', 'g'), '\beyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+', '[JWT]', 'g'), '(?i)\bbearer +[A-Za-z0-9._-]{8,}', '[BEARER]', 'g'), '\b\d{3}-\d{2}-\d{4}\b', '[SSN]', 'g')"""
_LUHN_D = _LUHN.replace("(d)", "(regexp_replace(x, '[ -]', '', 'g'))")


@query(rf"""WITH s AS (SELECT doc_id, {_SCRUB} AS t FROM {_D}), c AS (SELECT doc_id, t, list_filter(regexp_extract_all(t, '\b(\d(?:[ -]?\d){{12,18}})\b', 1), lambda x: {_LUHN_D}) AS cards FROM s)
SELECT doc_id, md5(regexp_replace(list_reduce(list_prepend(t, cards), lambda s, x: replace(s, x, '[CARD]')), '\+?\b\d{{0,3}}[ .-]?\(?\d{{3}}\)?[ .-]\d{{3}}[ .-]\d{{4}}\b', '[PHONE]', 'g')) AS scrubbed FROM c""")
def scrubbed_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Captured texts without contact data, tokens and valid card numbers."""
    return _docs(spark, folder).select("doc_id", F.md5(strings.scrubbed(F.col("text"))).alias("scrubbed"))


def _dates_sql() -> str:
    parts = []
    for pattern, (y, m, d) in strings.DATES:
        whole, one = f"({pattern})".replace("((?i)", "(?i)("), pattern
        month = f"lpad(CAST((instr('{strings.MONTHS}', lower(left(regexp_extract(x, '{one}', {m}), 3))) + 3) // 4 AS VARCHAR), 2, '0')" if strings.MONTHS in pattern else f"lpad(regexp_extract(x, '{one}', {m}), 2, '0')"
        parts.append(f"SELECT doc_id, try_cast(regexp_extract(x, '{one}', {y}) || '-' || {month} || '-' || lpad(regexp_extract(x, '{one}', {d}), 2, '0') AS DATE) AS day FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{whole}', 1)) AS x FROM {_D})")
    return "(" + " UNION ALL ".join(parts) + ")"


@query(f"SELECT doc_id, count(DISTINCT day) AS days, min(day) AS first_day, max(day) AS last_day FROM {_dates_sql()} WHERE day IS NOT NULL GROUP BY 1")
def named_days(spark: SparkSession, folder: str) -> DataFrame:
    """The calendar days that texts name in six notations."""
    rows = _docs(spark, folder).select("doc_id", strings.days_in(F.col("text")).alias("d")).where("size(d) > 0")
    return rows.select("doc_id", F.size("d").cast("bigint").alias("days"), F.array_min("d").alias("first_day"), F.array_max("d").alias("last_day"))


@query(r"""SELECT doc_id, count(*) AS paragraphs FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '\n[ \t\r]*\n')) AS p FROM documents WHERE text IS NOT NULL) WHERE len(list_distinct(regexp_extract_all(p, '\b\d{4}-\d{2}-\d{2}\b'))) >= 2 GROUP BY 1""")
def dual_dates(spark: SparkSession, folder: str) -> DataFrame:
    """How many paragraphs of a text name two days or more."""
    two = lambda p: F.size(F.array_distinct(F.regexp_extract_all(p, F.lit(r"(\b\d{4}-\d{2}-\d{2}\b)"), 1))) >= 2
    rows = _docs(spark, folder).select("doc_id", F.size(F.filter(F.split("text", r"\n[ \t\r]*\n"), two)).cast("bigint").alias("paragraphs"))
    return rows.where("paragraphs > 0")


@query(rf"SELECT doc_id, len(s) AS sentences, s[1] AS first FROM (SELECT doc_id, list_filter(string_split(regexp_replace(regexp_replace(text, '^ +| +$', '', 'g'), '([.!?])[ \t\n\r\f\x0B]+', '\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS s FROM {_D}) WHERE len(s) > 0")
def sentence_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = _docs(spark, folder).select("doc_id", strings.sentences(F.col("text")).alias("s")).where("size(s) > 0")
    return rows.select("doc_id", F.size("s").cast("bigint").alias("sentences"), F.col("s")[0].alias("first"))


@query(f"""SELECT doc_id, part, md5(substr(text, CAST(part * 900 + 1 AS BIGINT), 1000)) AS body FROM (SELECT doc_id, text, unnest(range(0, CAST(greatest(0, ceil((length(text) - 1000) / 900.0)) AS BIGINT) + 1)) AS part FROM {_D})""")
def char_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Windows of 1,000 characters that overlap by 100."""
    rows = _docs(spark, folder).select("doc_id", F.posexplode(strings.char_windows(F.col("text"), 1000, 100)).alias("part", "t"))
    return rows.select("doc_id", "part", F.md5("t").alias("body"))


@query(f"""SELECT storage_path, CASE lower(regexp_extract(storage_path, '\\.([A-Za-z0-9]+)$', 1)) {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in strings.LANGUAGES.items())} END AS language FROM (SELECT DISTINCT storage_path FROM {sql("files")})""")
def file_languages(spark: SparkSession, folder: str) -> DataFrame:
    rows = derived(spark, folder, "files").select("storage_path").distinct()
    return rows.select("storage_path", strings.language_of(F.col("storage_path")).alias("language"))


@query(r"SELECT doc_id, len(w) AS words, len(list_distinct(w)) AS kinds FROM (SELECT doc_id, regexp_extract_all(lower(text), '([\p{L}\p{N}]+)', 1) AS w FROM documents WHERE text IS NOT NULL)")
def unicode_words(spark: SparkSession, folder: str) -> DataFrame:
    rows = _docs(spark, folder).select("doc_id", strings.words_of(F.col("text")).alias("w"))
    return rows.select("doc_id", F.size("w").cast("bigint").alias("words"), F.size(F.array_distinct("w")).cast("bigint").alias("kinds"))


@query(r"""SELECT DISTINCT id, regexp_replace(regexp_replace(lower(title), '[ \t\r\n]+', ' ', 'g'), '^[ \[\](){}"'']+|[ \[\](){}"'']+$', '', 'g') AS alias FROM pages WHERE title IS NOT NULL""")
def alias_keys(spark: SparkSession, folder: str) -> DataFrame:
    return _pages(spark, folder, "title").where("title IS NOT NULL").select("id", strings.normalised_alias(F.col("title")).alias("alias"))


@query(r"""SELECT id, regexp_extract_all(t, '\[([a-z0-9][a-z0-9/_-]*#\d+)\]', 1)[1] AS first, len(list_distinct(regexp_extract_all(t, '\[([a-z0-9][a-z0-9/_-]*#\d+)\]', 1))) AS cited FROM (SELECT DISTINCT id, 'see [' || slug || '#' || CAST(id % 9 AS VARCHAR) || '] and [' || slug || '#0], [' || slug || '#0]' AS t FROM pages WHERE regexp_matches(slug, '^[a-z0-9][a-z0-9/_-]*$'))""")
def cited_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Citations of rows of pages, each once, in order."""
    pages = _pages(spark, folder, "slug").where(F.col("slug").rlike("^[a-z0-9][a-z0-9/_-]*$"))
    text = F.concat(F.lit("see ["), "slug", F.lit("#"), (F.col("id") % 9).cast("string"), F.lit("] and ["), "slug", F.lit("#0], ["), "slug", F.lit("#0]"))
    found = pages.select("id", strings.citations(text).alias("c"))
    return found.select("id", F.col("c")[0].alias("first"), F.size("c").cast("bigint").alias("cited"))


@query(rf"SELECT doc_id, substr(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '(?s)```.*?(```|$)', ' ', 'g'), '<[^>]*>', ' ', 'g'), '(?i)\b(ignore|disregard|forget) (all |any )?(previous|prior|above) (instructions|prompts|messages)\b', ' ', 'g'), '[ \t\r\n]+', ' ', 'g'), '^ +| +$', '', 'g'), 1, 200) AS query FROM {_D}")
def sanitised_queries(spark: SparkSession, folder: str) -> DataFrame:
    return _docs(spark, folder).select("doc_id", strings.sanitised(F.col("text")).alias("query"))


@query(f"""SELECT page_id, row_num, CASE WHEN row_num % 2 = 0 THEN claim ELSE trim(claim) END AS claim, row_num % 2 = 1 AS struck FROM {sql('claims')} WHERE claim NOT LIKE '%~~%' AND trim(claim) <> '' AND NOT contains(claim, chr(10)) AND NOT contains(claim, chr(13))""")
def struck_claims(spark: SparkSession, folder: str) -> DataFrame:
    """Struck-through cells give their text and the mark."""
    rows = derived(spark, folder, "claims").where(r"claim NOT LIKE '%~~%' AND trim(claim) <> '' AND NOT claim RLIKE '[\\n\\r]'")
    cell = F.when(F.col("row_num") % 2 == 1, F.concat(F.lit(" ~~"), F.trim("claim"), F.lit("~~ "))).otherwise(F.col("claim"))
    text, gone = strings.struck(cell)
    return rows.select("page_id", "row_num", text.alias("claim"), gone.alias("struck"))


@query(r"""SELECT DISTINCT id, nullif(regexp_extract(slug, '^(.*?(?:/|^)(?:chat|session|sessions)/[^/]+|.*?\d{4}-\d{2}-\d{2})', 1), '') AS session FROM pages""")
def session_prefixes(spark: SparkSession, folder: str) -> DataFrame:
    return _pages(spark, folder, "slug").select("id", strings.session_prefix(F.col("slug")).alias("session"))


@query(r"""SELECT doc_id, left(sha256(concat(source, '::', coalesce(title, ''), '::', 'k=60')), 32) AS key, left(sha256(coalesce(text, '')), 8) AS short FROM documents WHERE source IS NOT NULL""")
def cache_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of cached results: a hash of source, query and settings."""
    rows = table(spark, folder, "documents").where("source IS NOT NULL")
    key = F.substring(F.sha2(F.concat_ws("::", "source", F.coalesce("title", F.lit("")), F.lit("k=60")), 256), 1, 32)
    return rows.select("doc_id", key.alias("key"), F.substring(F.sha2(F.coalesce("text", F.lit("")), 256), 1, 8).alias("short"))


@query(f"""SELECT DISTINCT id, strftime(created_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS at, CASE WHEN slug LIKE 'media/%' OR slug LIKE 'files/%' THEN 'cold' WHEN slug LIKE 'archive/%' THEN 'archive' ELSE 'hot' END AS storage FROM pages WHERE created_at IS NOT NULL""")
def iso_times(spark: SparkSession, folder: str) -> DataFrame:
    """Times as ISO text to the microsecond, and the storage tier of a slug."""
    tier = F.when(F.col("slug").startswith("media/") | F.col("slug").startswith("files/"), "cold").when(F.col("slug").startswith("archive/"), "archive").otherwise("hot")
    return _pages(spark, folder, "created_at", "slug").where("created_at IS NOT NULL").select("id", F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("at"), tier.alias("storage"))


@query("""WITH w AS (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2025-10-01', INTERVAL 3 MONTH)) AS DATE) AS begins) SELECT begins, CAST(begins + INTERVAL 3 MONTH AS DATE) AS ends, count(d.doc_id) AS documents FROM w LEFT JOIN documents d ON d.created_at >= begins AND d.created_at < begins + INTERVAL 3 MONTH GROUP BY ALL""")
def quarter_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Quarters, with what falls into each: documents are counted by quarter before they meet the windows."""
    windows = spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit("2024-01-01")), F.to_date(F.lit("2025-10-01")), F.expr("INTERVAL 3 MONTH"))).alias("begins"))
    counts = table(spark, folder, "documents").where("created_at IS NOT NULL").groupBy(F.trunc("created_at", "quarter").alias("begins")).agg(F.count("*").alias("n"))
    return windows.join(counts, "begins", "left").select("begins", F.add_months("begins", 3).alias("ends"), F.coalesce("n", F.lit(0)).cast("bigint").alias("documents"))


@query("""WITH o AS (SELECT * FROM orders WHERE o_orderkey % 97 = 0) SELECT a.o_orderkey AS a, b.o_orderkey AS b FROM o a JOIN o b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey AND left(a.o_orderpriority, 1) = left(b.o_orderpriority, 1) AND abs(a.o_totalprice - b.o_totalprice) <= 0.1 * greatest(a.o_totalprice, b.o_totalprice)""")
def tolerant_matches(spark: SparkSession, folder: str) -> DataFrame:
    """Rows with one key whose amounts differ by a tenth at most. The set asked for is part of the question."""
    rows = table(spark, folder, "orders").where("o_orderkey % 97 = 0").select("o_orderkey", "o_custkey", "o_totalprice", F.substring("o_orderpriority", 1, 1).alias("p"))
    one, two = rows.toDF("a", "c", "x", "p"), rows.toDF("b", "c", "y", "p")
    return one.join(two, ["c", "p"]).where((F.col("a") < F.col("b")) & (F.abs(F.col("x") - F.col("y")) <= 0.1 * F.greatest("x", "y"))).select("a", "b")


@query(r"""WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(title), '[a-z]{6,}')) AS w FROM pages), k AS (SELECT w, left(w, 3) AS p FROM w)
SELECT a.w AS word, b.w AS near, CAST(levenshtein(a.w, b.w) AS INT) AS edits FROM k a JOIN k b ON a.p = b.p AND a.w <> b.w WHERE levenshtein(a.w, b.w) <= 3 QUALIFY row_number() OVER (PARTITION BY a.w ORDER BY levenshtein(a.w, b.w), b.w) = 1""")
def nearest_words(spark: SparkSession, folder: str) -> DataFrame:
    """For each title word the nearest other one with its first three letters, within three edits."""
    words = table(spark, folder, "pages").where("title IS NOT NULL").select(F.explode(F.regexp_extract_all(F.lower("title"), F.lit("([a-z]{6,})"), 1)).alias("word")).distinct().withColumn("p", F.substring("word", 1, 3))
    met = words.join(words.select(F.col("word").alias("near"), "p"), "p").where("word <> near").withColumn("edits", F.levenshtein("word", "near")).where("edits <= 3")
    return met.groupBy("word").agg(F.min(F.struct("edits", "near")).alias("m")).select("word", "m.near", "m.edits")


# --- semantic boundaries ----------------------------------------------------------------------------


@query(f"""WITH e AS (SELECT DISTINCT page_id, date AS day, length(summary) AS n, id FROM timeline_entries), s AS (SELECT *, row_number() OVER w AS pos,
(-2.0 * coalesce(lag(n, 2) OVER w, first_value(n) OVER w) - coalesce(lag(n, 1) OVER w, first_value(n) OVER w) + coalesce(lead(n, 1) OVER w, last_value(n) OVER v) + 2.0 * coalesce(lead(n, 2) OVER w, last_value(n) OVER v)) / 10 AS slope FROM e
WINDOW w AS (PARTITION BY page_id ORDER BY day, id), v AS (PARTITION BY page_id ORDER BY day, id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT page_id, id, round(slope, 6) AS slope, slope > 0 AND coalesce(lag(slope) OVER (PARTITION BY page_id ORDER BY pos) <= 0, false) AS turning FROM s""")
def smoothed_slopes(spark: SparkSession, folder: str) -> DataFrame:
    """First derivative of a page's series by a five-point filter whose ends repeat, and where it turns upward."""
    rows = table(spark, folder, "timeline_entries").select("page_id", F.col("date").alias("day"), F.length("summary").alias("n"), "id").distinct()
    order = Window.partitionBy("page_id").orderBy("day", "id")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first, last = F.first("n").over(whole), F.last("n").over(whole)
    back = lambda k: F.coalesce(F.lag("n", k).over(order), first)
    ahead = lambda k: F.coalesce(F.lead("n", k).over(order), last)
    found = rows.withColumn("slope", (-2.0 * back(2) - back(1) + ahead(1) + 2.0 * ahead(2)) / 10)
    turning = (F.col("slope") > 0) & F.coalesce(F.lag("slope").over(order) <= 0, F.lit(False))
    return found.select("page_id", "id", F.round("slope", 6).alias("slope"), turning.alias("turning"))


@query(rf"""SELECT doc_id, line_no, regexp_extract(line, '^[ \t]*(?:[-*+]|\d+[.)])[ \t]+(.*)$', 1) AS item FROM (SELECT doc_id, generate_subscripts(l, 1) - 1 AS line_no, unnest(l) AS line FROM (SELECT doc_id, regexp_split_to_array(text, '\r?\n') AS l FROM {_D})) WHERE regexp_matches(line, '^[ \t]*(?:[-*+]|\d+[.)])[ \t]+.*$')""")
def list_items(spark: SparkSession, folder: str) -> DataFrame:
    shape = r"^[ \t]*(?:[-*+]|\d+[.)])[ \t]+(.*)$"
    found = documents.lines(table(spark, folder, "documents"), "doc_id", "text").where(F.col("line").rlike(shape))
    return found.select("doc_id", "line_no", F.regexp_extract("line", shape, 1).alias("item"))


@query(f"SELECT id, page_id, concat('[', coalesce(symbol_type, 'text'), '] ', coalesce(concat_ws('.', language, symbol_name), ''), ' ', length(chunk_text)) AS head FROM (SELECT DISTINCT id, page_id, symbol_type, language, symbol_name, chunk_text FROM content_chunks WHERE chunk_text IS NOT NULL)")
def chunk_heads(spark: SparkSession, folder: str) -> DataFrame:
    """What is put before a chunk when it is embedded: kind and qualified symbol."""
    rows = _chunks(spark, folder, "page_id", "symbol_type", "language", "symbol_name", F.length("chunk_text").alias("n")).where("n IS NOT NULL")
    head = F.concat(F.lit("["), F.coalesce("symbol_type", F.lit("text")), F.lit("] "), F.concat_ws(".", "language", "symbol_name"), F.lit(" "), F.col("n").cast("string"))
    return rows.select("id", "page_id", head.alias("head"))
