"""Full-text search: stems, a small query language, and weighted ranks. All expressions run in the JVM.

Query language: words must all stand in the text; "in quotes" they must follow each other; ``-word``
must not; ``or`` between two words lets either do. Words are stemmed by stripping common English
endings; the same rules hold for texts and queries.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Weights of the fields a rank adds up, from titles and symbols to remarks.
WEIGHTS = {"A": 1.0, "B": 0.4, "C": 0.2, "D": 0.1}
#: Endings that stemming strips, in turn: pattern and what stays.
ENDINGS = ((r"ies$", "y"), (r"([^s])s$", r"\1"), (r"(\w{3})(?:ing|ed)$", r"\1"), (r"(\w{3})ly$", r"\1"))


def stem(word: str) -> str:
    for pattern, kept in ENDINGS:
        word = re.sub(pattern, kept, word, flags=re.A)
    return word


def stems(text: Column) -> Column:
    """The stemmed words of a text, in order."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"([a-z0-9]+)"), 1)

    def one(word: Column) -> Column:
        for pattern, kept in ENDINGS:
            word = F.regexp_replace(word, pattern, kept.replace("\\", "$"))
        return word

    return F.transform(found, one)


@dataclass
class Query:
    """A parsed query: alternatives (any of each must match), phrases and words that must not stand."""

    every: list[list[str]] = field(default_factory=list)
    phrases: list[list[str]] = field(default_factory=list)
    without: list[str] = field(default_factory=list)

    @property
    def words(self) -> list[str]:
        return list(dict.fromkeys([w for group in self.every for w in group] + [w for phrase in self.phrases for w in phrase]))


def parse(text: str) -> Query:
    out, either = Query(), False
    for quoted, minus, word in re.findall(r'"([^"]*)"|(-?)([^\s"]+)', text):
        if quoted:
            words = [stem(w) for w in re.findall(r"[a-z0-9]+", quoted.lower())]
            if words:
                out.phrases.append(words)
            continue
        if word.lower() == "or" and out.every:
            either = True
            continue
        for part in re.findall(r"[a-z0-9]+", word.lower()):
            if minus:
                out.without.append(stem(part))
            elif either:
                out.every[-1].append(stem(part))
            else:
                out.every.append([stem(part)])
        either = False
    return out


def matches(query: Query, words: Column) -> Column:
    """Whether an array of stems answers a query."""
    line = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    out = F.lit(True)
    for group in query.every:
        any_of = F.lit(False)
        for word in group:
            any_of = any_of | F.array_contains(words, word)
        out = out & any_of
    for phrase in query.phrases:
        out = out & line.contains(f" {' '.join(phrase)} ")
    for word in query.without:
        out = out & ~F.array_contains(words, word)
    return out


def _count(words: str, word: str) -> Column:
    return F.size(F.filter(words, lambda w: w == word)).cast("double")


def search(df: DataFrame, text: str, fields: Mapping[str, str]) -> DataFrame:
    """Rows whose fields together answer a query, with a rank.

    ``fields`` gives each column its weight class. The rank adds, for each word of the query and each
    field, weight * n / (n + 1) for n occurrences, and is divided by the number of words asked for.
    """
    query = parse(text)
    if not query.words:
        return df.withColumn("rank", F.lit(0.0)).limit(0)
    for word in query.words if not any(len(g) > 1 for g in query.every) else []:  # a cheap test on the scan before words are made
        stub = word[:-1] if word.endswith("y") else word
        any_field = F.lit(False)
        for column in fields:
            any_field = any_field | F.lower(F.coalesce(column, F.lit(""))).contains(stub)
        df = df.where(any_field)
    made = df.select("*", *[stems(F.col(c)).alias(f"__{c}") for c in fields])
    together = F.concat(*[f"__{c}" for c in fields])
    rank = F.lit(0.0)
    for column, weight in fields.items():
        for word in query.words:
            n = _count(f"__{column}", word)
            rank = rank + WEIGHTS[weight] * n / (n + 1)
    found = made.where(matches(query, together)).withColumn("rank", rank / len(query.words))
    return found.drop(*[f"__{c}" for c in fields])


def postings(df: DataFrame, key: str, fields: Mapping[str, str]) -> DataFrame:
    """(term, key, weight, positions): the inverted index of some fields, to be stored by term and asked many times.

    Words are combined by (term, key, weight) before and after the shuffle; a hot term is many rows.
    """
    out = None
    for column, weight in fields.items():
        part = df.select(key, F.lit(weight).alias("weight"), F.posexplode(stems(F.col(column))).alias("at", "term"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("term", key, "weight").agg(F.array_sort(F.collect_set("at")).alias("positions"))


def search_postings(index: DataFrame, key: str, text: str) -> DataFrame:
    """(key, rank): what ``search`` gives, from an index: only the rows of the words asked for are read.

    Words of a phrase follow each other inside one weight class.
    """
    query = parse(text)
    rows = index.where(F.col("term").isin([*query.words, *query.without]))
    if not query.words:
        return rows.select(key, F.lit(0.0).alias("rank")).limit(0)
    each = rows.groupBy(key, "weight").agg(F.map_from_entries(F.collect_list(F.struct("term", "positions"))).alias("m"))
    none = F.expr("CAST(array() AS array<int>)")
    at = lambda word: F.coalesce(F.element_at("m", word), none)
    rank = F.lit(0.0)
    for word in query.words:
        n = F.size(at(word)).cast("double")
        rank = rank + n / (n + 1)
    classes = F.lit(0.0)
    for name, value in WEIGHTS.items():
        classes = F.when(F.col("weight") == name, value).otherwise(classes)
    found = {f"w{i}": F.max(F.size(at(word)) > 0).alias(f"w{i}") for i, word in enumerate([*query.words, *query.without])}
    runs = []
    for i, phrase in enumerate(query.phrases):
        runs.append(F.max(F.exists(at(phrase[0]), _follows(at, phrase))).alias(f"p{i}"))
    told = each.groupBy(key).agg(F.sum(rank * classes).alias("rank"), *found.values(), *runs)
    place = {word: f"w{i}" for i, word in enumerate([*query.words, *query.without])}
    keep = F.lit(True)
    for group in query.every:
        any_of = F.lit(False)
        for word in group:
            any_of = any_of | F.col(place[word])
        keep = keep & any_of
    for i in range(len(query.phrases)):
        keep = keep & F.col(f"p{i}")
    for word in query.without:
        keep = keep & ~F.col(place[word])
    return told.where(keep).select(key, (F.col("rank") / len(query.words)).alias("rank"))


def _follows(at, phrase: list[str]):
    """Whether the other words of a phrase follow a position of the first."""

    def test(x: Column) -> Column:
        out = F.lit(True)
        for n, word in enumerate(phrase[1:], 1):
            out = out & F.array_contains(at(word), x + n)
        return out

    return test


def stem_sql(text: str) -> str:
    """The same stems in SQL, for the queries' checks."""
    out = "w"
    for pattern, kept in ENDINGS:
        out = f"regexp_replace({out}, '{pattern}', '{kept}')"
    return f"list_transform(regexp_extract_all(lower(coalesce({text}, '')), '([a-z0-9]+)', 1), lambda w: {out})"
