"""Column expressions over text; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: accented Latin letters and what they become in slugs.
ACCENTS = ("àáâãäåçèéêëìíîïñòóôõöøùúûüýÿ", "aaaaaaceeeeiiiinoooooouuuuyy")


def fold(text: Column) -> Column:
    """Lower case, common Latin accents stripped."""
    return F.translate(F.lower(text), *ACCENTS)


def slugify(text: Column) -> Column:
    """Letters and digits of the folded text, runs of anything else as one hyphen, none at the ends."""
    return F.regexp_replace(F.regexp_replace(fold(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def estimated_tokens(text: Column) -> Column:
    """A quarter of the length, rounded up."""
    return F.ceil(F.length(text) / 4).cast("bigint")


def word_count(text: Column) -> Column:
    """Words, or single characters where 30 % or more of the visible ones are Chinese, Japanese or Korean."""
    seen = F.regexp_replace(text, r"\s", "")
    cjk = F.length(F.regexp_replace(seen, "[^぀-ヿ㐀-䶿一-鿿가-힯]", ""))
    words = F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))
    return F.when((F.length(seen) > 0) & (cjk >= 0.3 * F.length(seen)), F.length(seen)).otherwise(words).cast("bigint")


def trigrams(text: Column) -> Column:
    """Distinct trigrams of the words of a text, each word padded by two blanks before and one behind."""
    words = F.filter(F.split(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "), " "), lambda w: w != "")
    grams = F.transform(words, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3))))
    return F.array_distinct(F.flatten(grams))


def similarity(a: Column, b: Column) -> Column:
    """Shared over all trigrams of two texts."""
    x, y = trigrams(a), trigrams(b)
    union = F.size(F.array_union(x, y))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(x, y)) / union)


def plain_text(html: Column) -> Column:
    """Text of an HTML fragment: scripts and styles dropped, tags to blanks, common entities decoded."""
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>", " ")
    text = F.regexp_replace(text, r"(?s)<[^>]*>", " ")
    for entity, plain in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def without_code(text: Column) -> Column:
    """The text without fenced and inline code."""
    return F.regexp_replace(F.regexp_replace(text, r"(?s)```.*?(```|$)", ""), "`[^`\n]*`", "")


def alias_key(text: Column) -> Column:
    """Key of a free-text alias: lower case, white space as one blank, no brackets or quotes at the ends."""
    return F.regexp_replace(F.trim(F.regexp_replace(F.lower(text), r"\s+", " ")), "^[\\[\\](){}\"'“”]+|[\\[\\](){}\"'“”]+$", "")


def wiki_targets(text: Column) -> Column:
    """Targets of [[target]] and [[target|label]] links outside code, in order."""
    found = F.regexp_extract_all(without_code(text), F.lit(r"\[\[([^\]|\n]+)(?:\|[^\]\n]*)?\]\]"), 1)
    return F.transform(found, lambda t: F.lower(F.trim(t)))
