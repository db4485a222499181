"""Hybrid search: keyword and vector arms, fusion, rescoring, boosts and the layers of deduplication.

Each arm gives its best chunk of each page; only the heads of the arms (some dozens of rows) meet in
the fusion, so everything behind it is small whatever the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import strings
from ..functions.scores import cosine
from . import fulltext, search


def keyword_arm(chunks: DataFrame, pages: DataFrame, text: str, limit: int = 60, detail: str = "medium") -> DataFrame:
    """(page_id, chunk_id, truth, score, rank): each page's best chunk for a query, the best pages first."""
    hits = fulltext.search(chunks, text, {"chunk_text": "B"}).withColumnRenamed("rank", "score")
    return _pooled(hits, pages, limit, detail)


def vector_arm(chunks: DataFrame, pages: DataFrame, query: Sequence[float], limit: int = 60, detail: str = "medium") -> DataFrame:
    """(page_id, chunk_id, truth, score, rank): each page's chunk most similar to a query vector, with its cosine."""
    usable = F.col("embedding").isNotNull() & (F.size("embedding") == len(query))
    hits = chunks.where(usable).withColumn("score", cosine(F.col("embedding"), F.array(*[F.lit(float(x)) for x in query])))
    return _pooled(hits, pages, limit, detail)


def _pooled(hits: DataFrame, pages: DataFrame, limit: int, detail: str) -> DataFrame:
    """One row a page by an aggregate that combines before the shuffle; ties go to the smaller chunk."""
    rows = hits.join(pages.select(F.col("id").alias("page_id"), "slug"), "page_id")
    rows = rows.withColumn("weighed", F.col("score") * strings.prefix_factor(F.col("slug"), detail=detail))
    best = rows.groupBy("page_id").agg(F.max(F.struct("weighed", (-F.col("id")).alias("minus"), F.col("chunk_source").eqNullSafe("compiled_truth").alias("truth"), "score")).alias("b"))
    found = best.select("page_id", (-F.col("b.minus")).alias("chunk_id"), "b.truth", F.col("b.score").alias("raw"), F.col("b.weighed").alias("score"))
    return search.ranked(found, limit, "page_id")


def fused(arms: Sequence[DataFrame], k: int = 60, weights: Sequence[float] | None = None, detail: str = "medium") -> DataFrame:
    """(page_id, chunk_id, truth, score): reciprocal ranks of the arms, k / weight each, the best scaled to 1; chunks of the body count twice."""
    parts = None
    for n, (arm, weight) in enumerate(zip(arms, weights or [1.0] * len(arms))):
        part = arm.select("page_id", F.struct(F.lit(n).alias("n"), "chunk_id", "truth").alias("c"), (1 / (F.lit(k / weight) + F.col("rank"))).alias("part"))
        parts = part if parts is None else parts.union(part)
    total = parts.groupBy("page_id").agg(F.sum("part").alias("total"), F.min("c").alias("c"))
    scaled = F.col("total") / F.max("total").over(Window.partitionBy(F.lit(0)))  # the heads of the arms
    doubled = F.lit(1.0) if detail == "high" else F.when(F.col("c.truth"), 2.0).otherwise(1.0)
    return total.select("page_id", "c.chunk_id", "c.truth", (scaled * doubled).alias("score"))


def rescored(rows: DataFrame, vectors: DataFrame, share: float = 0.7) -> DataFrame:
    """rows with share * score / max + (1 - share) * cosine; rows without a vector keep their score.

    ``vectors``: (page_id, raw), the cosine of each page's best chunk.
    """
    top = F.max("score").over(Window.partitionBy(F.lit(0)))
    both = rows.withColumn("scaled", F.col("score") / top).join(vectors.select("page_id", "raw"), "page_id", "left")
    return both.withColumn("score", F.when(F.col("raw").isNotNull(), share * F.col("scaled") + (1 - share) * F.col("raw")).otherwise(F.col("score"))).drop("scaled", "raw")


def unlike(rows: DataFrame, text: str, most: float = 0.85) -> DataFrame:
    """A ranking of at most a few hundred rows without those too like a better one: greedy Jaccard over words, as one fold."""
    order = F.struct((-F.col("score")).alias("minus"), "id")
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"([a-z0-9]+)"), 1))
    listed = rows.agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), F.col("id").alias("i"), words.alias("w")))).alias("l"))

    def alike(a: Column, b: Column) -> Column:
        union = F.size(F.array_union(a, b))
        return (union > 0) & (F.size(F.array_intersect(a, b)) / union > most)

    none = F.expr("CAST(array() AS array<struct<i:bigint,w:array<string>>>)")
    one = lambda x: F.struct(x["i"].cast("bigint").alias("i"), x["w"].alias("w"))
    kept = F.aggregate("l", none, lambda seen, x: F.when(F.exists(seen, lambda y: alike(y["w"], x["w"])), seen).otherwise(F.concat(seen, F.array(one(x)))))
    return rows.join(F.broadcast(listed.select(F.explode(kept).alias("k")).select(F.col("k.i").alias("id"))), "id", "left_semi")  # no more rows than the ranking


def deduplicated(rows: DataFrame, text: str, limit: int = 100, first: int = 3, share: float = 0.6, last: int = 2, most: float = 0.85) -> DataFrame:
    """The five layers over ranked chunks (id, page_id, type, truth, score, text).

    ``first`` chunks a page; no chunk too like a better one; no type with more than its share; ``last``
    chunks a page; and where a page has no chunk of its body left, its lowest one gives way to the best
    chunk of its body before the layers.
    """
    head = search.ranked(rows, limit, "id").drop("rank")
    some = search.best_per(head, ["page_id"], first)
    unlike_rows = unlike(some, text, most)
    mixed = search.capped_share(unlike_rows, "type", share, limit, "id")
    final = search.best_per(mixed, ["page_id"], last)
    truths = head.where("truth").groupBy("page_id").agg(F.max_by("id", F.struct("score", (-F.col("id")).alias("m"))).alias("truth_id"))
    has = final.groupBy("page_id").agg(F.max("truth").alias("has"), F.min_by("id", F.struct("score", (-F.col("id")).alias("m"))).alias("low_id"))
    swap = has.where("NOT has").join(truths, "page_id").select("low_id", "truth_id")
    return final.join(swap, final["id"] == swap["low_id"], "left").select("page_id", F.coalesce("truth_id", "id").alias("id"), "score")
