"""Keyword, vector and fused search, and the steps behind a ranking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scores import cosine


def keyword_hits(chunks: DataFrame, terms: Sequence[str], text: str = "chunk_text") -> DataFrame:
    """Chunks that hold all terms as words, with a score: sum over terms of log2(1 + count), by log2 of the length.

    The terms' tests run on the scan; no postings table is shuffled.
    """
    low = F.lower(F.col(text))
    score = F.lit(0.0)
    for term in terms:
        count = F.regexp_count(low, F.lit(rf"(?<![a-z0-9]){term.lower()}(?![a-z0-9])"))
        chunks = chunks.where(low.contains(term.lower()) & (count > 0))
        score = score + F.log2(1 + count.cast("double"))
    return chunks.withColumn("score", score / F.log2(2 + F.length(text).cast("double")))


def substring_hits(chunks: DataFrame, needle: str, text: str = "chunk_text") -> DataFrame:
    """Fallback for scripts without word gaps: occurrences plus the inverse of the first position."""
    low = F.lower(F.col(text))
    at = F.instr(low, needle.lower())
    count = (F.length(low) - F.length(F.replace(low, F.lit(needle.lower()), F.lit("")))) / len(needle)
    return chunks.where(at > 0).withColumn("score", count + 1 / at)


def vector_hits(chunks: DataFrame, query: Sequence[float], vector: str = "embedding") -> DataFrame:
    """Usable vectors with their cosine to the query."""
    usable = F.col(vector).isNotNull() & (F.size(vector) == len(query))
    return chunks.where(usable).withColumn("score", cosine(F.col(vector), F.array(*[F.lit(float(x)) for x in query])))


def best_per(df: DataFrame, by: Sequence[str], keep: int = 1, order: Sequence[Column] | None = None) -> DataFrame:
    """The ``keep`` best-scored rows of each group."""
    ranked = Window.partitionBy(*by).orderBy(*(order or [F.desc("score"), F.asc("id")]))
    return df.withColumn("__rank", F.row_number().over(ranked)).where(F.col("__rank") <= keep).drop("__rank")


def ranked(df: DataFrame, limit: int, *ties: str) -> DataFrame:
    """The ``limit`` best rows with their rank from 0: a top-k first, so only they meet in one task."""
    order = [F.desc("score"), *[F.asc(t) for t in ties]]
    return df.orderBy(*order).limit(limit).withColumn("rank", F.row_number().over(Window.orderBy(*order)) - 1)


def fused(arms: Sequence[DataFrame], key: str, k: int = 60, weights: Sequence[float] | None = None) -> DataFrame:
    """(key, score): reciprocal-rank fusion of ranked lists, the best scaled to 1."""
    weights = weights or [1.0] * len(arms)
    parts = None
    for arm, weight in zip(arms, weights):
        part = arm.select(F.col(key), (F.lit(weight) / (k + F.col("rank"))).alias("part"))
        parts = part if parts is None else parts.union(part)
    total = parts.groupBy(key).agg(F.sum("part").alias("total"))
    top = total.agg(F.max("total").alias("top"))
    return total.crossJoin(F.broadcast(top)).select(key, (F.col("total") / F.col("top")).alias("score"))  # one row


def capped_share(df: DataFrame, by: str, share: float, limit: int, *ties: str) -> DataFrame:
    """A ranking in which no value of ``by`` takes more than the given share (rounded up) of its rows."""
    order = [F.desc("score"), *[F.asc(t) for t in ties]]
    head = df.orderBy(*order).limit(limit)
    n = head.agg(F.count("*").alias("__n"))
    placed = head.withColumn("__at", F.row_number().over(Window.partitionBy(by).orderBy(*order)))
    return placed.crossJoin(F.broadcast(n)).where(F.col("__at") <= F.ceil(F.col("__n") * share)).drop("__at", "__n")


def within_budget(df: DataFrame, cost: str, budget: int, order: Sequence[Column], by: Sequence[str] = (), place: Column | None = None, block: int = 256) -> DataFrame:
    """The longest beginning of each ordered group whose costs (none below zero) stay within a budget.

    ``place`` is a whole number that ascends with the order: with it, sums are taken inside blocks of
    places, then over the blocks' totals, so no group is gathered in one task.
    """
    if place is None:
        at = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy(*order)
        return df.withColumn("spent", F.sum(cost).over(at.rowsBetween(Window.unboundedPreceding, 0))).where(F.col("spent") <= budget)
    rows = df.withColumn("__block", F.floor(place / block))
    totals = rows.groupBy(*by, "__block").agg(F.sum(cost).alias("__total"))
    before = Window.partitionBy(*by).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*by, "__block", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__start")).where(F.col("__start") <= budget)
    at = Window.partitionBy(*by, "__block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.join(starts, [*by, "__block"]).withColumn("spent", F.col("__start") + F.sum(cost).over(at))
    return inside.where(F.col("spent") <= budget).drop("__block", "__start")


def quality(hits: DataFrame, judged: DataFrame, k: int) -> DataFrame:
    """(query, precision, recall, reciprocal_rank, ndcg) at k.

    hits: (query, doc, rank from 1); judged: (query, doc). Queries without judgements are left out.
    """
    size = judged.distinct().groupBy("query").agg(F.count("*").alias("relevant"))
    met = hits.where(F.col("rank") <= k).join(judged.distinct(), ["query", "doc"])
    gained = met.groupBy("query").agg(F.count("*").alias("found"), F.min("rank").alias("first"), F.sum(1 / F.log2(F.col("rank") + 1.0)).alias("gain"))
    ideal = F.aggregate(F.sequence(F.lit(1), F.least("relevant", F.lit(k))), F.lit(0.0), lambda s, i: s + 1 / F.log2(i + 1.0))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return size.join(gained, "query", "left").select(
        "query", zero(F.col("found") / k).alias("precision"), zero(F.col("found") / F.col("relevant")).alias("recall"),
        zero(1.0 / F.col("first")).alias("reciprocal_rank"), zero(F.col("gain") / ideal).alias("ndcg"),
    )
