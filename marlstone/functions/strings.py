"""Further column expressions over text: masks, dates, chunk windows, keys. All run inside the JVM."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# What search results under a prefix of slugs are multiplied with; the longest prefix counts.
PREFIX_FACTORS = {
    "originals/": 1.5, "concepts/": 1.3, "writing/": 1.4, "people/": 1.2, "companies/": 1.2, "deals/": 1.2, "meetings/": 1.1, "media/articles/": 1.1, "media/repos/": 1.1,
    "yc/": 1.0, "civic/": 1.0, "daily/": 0.8, "media/x/": 0.7, "archive/": 0.5, "extracts/": 0.3,
}
# Prefixes that searches leave out.
HIDDEN_PREFIXES = ("test/", "attachments/", ".raw/")
# File endings and the languages of code.
LANGUAGES = {
    "ts": "typescript", "tsx": "typescript", "js": "javascript", "jsx": "javascript", "py": "python", "rb": "ruby", "go": "go", "rs": "rust", "java": "java", "kt": "kotlin", "c": "c",
    "h": "c", "cpp": "cpp", "cs": "c_sharp", "php": "php", "swift": "swift", "scala": "scala", "sh": "bash", "sql": "sql", "lua": "lua", "ex": "elixir", "hs": "haskell",
}
MONTHS = "jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec"
#: The notations of dates: pattern, and the group numbers of year, month, day.
DATES = (
    (r"\b(\d{4})-(\d{2})-(\d{2})\b", (1, 2, 3)), (r"\b(\d{4})/(\d{1,2})/(\d{1,2})\b", (1, 2, 3)), (r"\b(\d{1,2})\.(\d{1,2})\.(\d{4})\b", (3, 2, 1)), (r"\b(\d{1,2})/(\d{1,2})/(\d{4})\b", (3, 1, 2)),
    (rf"(?i)\b({MONTHS})[a-z]*\.? (\d{{1,2}})(?:st|nd|rd|th)?,? (\d{{4}})\b", (3, 1, 2)), (rf"(?i)\b(\d{{1,2}})(?:st|nd|rd|th)? ({MONTHS})[a-z]*\.?,? (\d{{4}})\b", (3, 2, 1)),
)


def like_escaped(text: Column) -> Column:
    """Text whose LIKE wildcards and backslashes stand for themselves."""
    return F.regexp_replace(text, r"([%_\\])", r"\\$1")


def prefix_factor(slug: Column, factors: Mapping[str, float] = PREFIX_FACTORS, detail: str = "medium") -> Column:
    """The factor of the longest prefix that a slug has, 1 without one or for searches in high detail."""
    if detail == "high":
        return F.lit(1.0)
    out = F.lit(1.0)
    for prefix in sorted(factors, key=lambda p: (len(p), p)):
        out = F.when(slug.startswith(prefix), F.lit(float(factors[prefix]))).otherwise(out)
    return out


def hidden(slug: Column, prefixes: tuple[str, ...] = HIDDEN_PREFIXES) -> Column:
    out = F.lit(False)
    for prefix in prefixes:
        out = out | slug.startswith(prefix)
    return out


def blanked(text: Column, spans: Column) -> Column:
    """The text with each of the spans (strings) replaced by as many blanks."""
    return F.aggregate(spans, text, lambda s, x: F.replace(s, x, F.repeat(F.lit(" "), F.length(x))))


def masked_code(text: Column) -> Column:
    """The text with fenced and inline code as blanks, so positions stay."""
    fenced = blanked(text, F.regexp_extract_all(text, F.lit(r"(?s)(```.*?(?:```|\z))"), 1))
    return blanked(fenced, F.regexp_extract_all(fenced, F.lit(r"(`[^`\n]+`)"), 1))


def markup_ratio(text: Column) -> Column:
    """The share of characters that stripping code, images, links and tags takes away."""
    left = F.regexp_replace(text, r"(?s)```.*?```", "")
    for pattern, kept in ((r"!\[[^\]]*\]\([^)]*\)", ""), (r"\[([^\]]*)\]\([^)]*\)", "$1"), (r"\[\[([^\]]*)\]\]", "$1"), (r"<[^>]+>", ""), (r"[#*_>`|-]", "")):
        left = F.regexp_replace(left, pattern, kept)
    return F.when(F.length(text) > 0, 1 - F.length(left) / F.length(text)).otherwise(0.0)


def rounded_weight(weight: Column) -> Column:
    """A weight between 0 and 1 in steps of 0.05."""
    return F.floor(F.least(F.greatest(weight, F.lit(0.0)), F.lit(1.0)) * 20 + 0.5) / 20


def scrubbed(text: Column) -> Column:
    """Emails, tokens, social security numbers, valid card numbers and telephone numbers as their kinds."""
    for pattern, label in (
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "[EMAIL]"), (r"\beyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", "[JWT]"),
        (r"(?i)\bbearer +[A-Za-z0-9._-]{8,}", "[BEARER]"), (r"\b\d{3}-\d{2}-\d{4}\b", "[SSN]"),
    ):
        text = F.regexp_replace(text, pattern, label)
    cards = F.filter(F.regexp_extract_all(text, F.lit(r"\b(\d(?:[ -]?\d){12,18})\b"), 1), lambda x: F.call_function("luhn_check", F.regexp_replace(x, "[ -]", "")))
    text = F.aggregate(cards, text, lambda s, x: F.replace(s, x, F.lit("[CARD]")))
    return F.regexp_replace(text, r"\+?\b\d{0,3}[ .-]?\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}\b", "[PHONE]")


def days_in(text: Column) -> Column:
    """The distinct valid calendar days that a text names in any of six notations, ascending."""
    found = [_days(text, pattern, *order) for pattern, order in DATES]
    return F.array_sort(F.array_distinct(F.filter(F.concat(*found), lambda d: d.isNotNull())))


def _days(text: Column, pattern: str, year: int, month: int, day: int) -> Column:
    """The days of one notation, null for those that no calendar has."""
    hits = F.regexp_extract_all(text, F.lit(f"({pattern})".replace("((?i)", "(?i)(")), 1)

    def made(x: Column) -> Column:
        m = F.regexp_extract(x, pattern, month)
        if MONTHS in pattern:
            m = F.floor((F.instr(F.lit(MONTHS), F.lower(F.substring(m, 1, 3))) + 3) / 4).cast("string")
        two = lambda c: F.lpad(c, 2, "0")
        return F.try_to_date(F.concat_ws("-", F.regexp_extract(x, pattern, year), two(m), two(F.regexp_extract(x, pattern, day))), "yyyy-MM-dd")

    return F.transform(hits, made)


def lenient_day(text: Column) -> Column:
    """The first day a text names."""
    return F.try_element_at(days_in(text), F.lit(1))


def sentences(text: Column) -> Column:
    """The text split behind full stops, exclamation and question marks."""
    return F.filter(F.split(F.trim(text), r"(?<=[.!?])\s+"), lambda s: s != "")


def char_windows(text: Column, size: int = 6000, overlap: int = 500) -> Column:
    """Overlapping windows of characters; the last one ends with the text."""
    last = F.greatest(F.lit(0), F.ceil((F.length(text) - size) / (size - overlap))).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(text, i * (size - overlap) + 1, F.lit(size)))


def language_of(path: Column) -> Column:
    """The language of a file by its ending, null for others."""
    end = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    return F.element_at(F.create_map(*[F.lit(x) for pair in LANGUAGES.items() for x in pair]), F.when(end != "", end))


def words_of(text: Column) -> Column:
    """Lower-cased maximal runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), 1)


def normalised_alias(text: Column) -> Column:
    """Lower case, white space as one blank, none of it or of quotes and brackets at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), r"[ \t\r\n]+", " "), "^[ \\[\\](){}\"']+|[ \\[\\](){}\"']+$", "")


def citations(text: Column) -> Column:
    """Distinct [slug#row] citations in the order of their first occurrence."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"\[([a-z0-9][a-z0-9/_-]*#\d+)\]"), 1))


def sanitised(text: Column, limit: int = 200) -> Column:
    """A query without code fences, tags and instructions to a model, as one line of at most ``limit`` characters."""
    out = F.regexp_replace(text, r"(?s)```.*?(```|$)", " ")
    out = F.regexp_replace(out, r"<[^>]*>", " ")
    out = F.regexp_replace(out, r"(?i)\b(ignore|disregard|forget) (all |any )?(previous|prior|above) (instructions|prompts|messages)\b", " ")
    return F.substring(F.trim(F.regexp_replace(out, r"[ \t\r\n]+", " ")), 1, limit)


def distance(cosine: Column) -> Column:
    """Half of one less the cosine, between 0 and 1; a half where there is none."""
    return F.coalesce(F.least(F.greatest(1 - cosine, F.lit(0.0)), F.lit(2.0)) / 2, F.lit(0.5))


def struck(text: Column) -> tuple[Column, Column]:
    """(text without the marks, whether it was struck through)."""
    inner = F.regexp_extract(text, r"^\s*~~(.*)~~\s*$", 1)
    return F.when(inner != "", inner).otherwise(text), inner != ""


def session_prefix(slug: Column) -> Column:
    """The part of a slug that its session shares: up to a chat or session segment or a date; else null."""
    found = F.regexp_extract(slug, r"^(.*?(?:/|^)(?:chat|session|sessions)/[^/]+|.*?\d{4}-\d{2}-\d{2})", 1)
    return F.when(found != "", found)


def without_section(text: Column, begin: str, end: str) -> Column:
    """The text without what stands between two marker lines, and these."""
    return F.regexp_replace(text, rf"(?s){begin}.*?{end}\n?", "")
