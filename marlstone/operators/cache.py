"""A cache of query results: nearest cached query, freshness by age and by page generations, upsert and prune.

A cache is a table (key, vector, knobs, made_at, results, made_from), where made_from maps each page
behind the results to its generation of then. Entries hold for queries near enough, of the same
settings, while they are young and no page behind them has changed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scores import cosine

#: Least cosine of a query to a cached one that may answer it, and how long entries hold.
NEAR, HOURS = 0.92, 24

SCHEMA = "key string, vector array<float>, knobs string, made_at timestamp_ntz, results array<int>, made_from map<int,bigint>"


def cache_key(source: Column, query: Column, knobs: str) -> Column:
    return F.substring(F.sha2(F.concat_ws("::", source, query, F.lit(knobs)), 256), 1, 32)


def snapshot(pages: DataFrame, results: DataFrame) -> DataFrame:
    """(key, results, made_from) of (key, page_id, rank): each query's pages in order, with their generations."""
    now = pages.select(F.col("id").alias("page_id"), "generation").distinct()
    rows = results.join(now, "page_id", "left").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("rank", "page_id", F.coalesce("generation", F.lit(0).cast("bigint")).alias("g")))).alias("l"))
    return rows.select("key", F.transform("l", lambda x: x["page_id"]).alias("results"), F.map_from_entries(F.array_distinct(F.transform("l", lambda x: F.struct(x["page_id"], x["g"])))).alias("made_from"))


def put(cache: DataFrame, rows: DataFrame) -> DataFrame:
    """The cache with entries replaced by key; of several, the newest holds."""
    both = cache.unionByName(rows)
    return both.groupBy("key").agg(F.max_by(F.struct(*[c for c in cache.columns if c != "key"]), "made_at").alias("e")).select("key", "e.*")


def pruned(cache: DataFrame, now: str, hours: int = HOURS) -> DataFrame:
    """The cache without entries that are too old."""
    return cache.where(F.col("made_at") > F.to_timestamp_ntz(F.lit(now)) - F.expr(f"INTERVAL {hours} HOUR"))


def fresh(cache: DataFrame, pages: DataFrame, now: str, hours: int = HOURS) -> DataFrame:
    """Entries that are young and whose pages all have the generations they were made from."""
    young = pruned(cache, now, hours)
    each = young.select("key", F.explode("made_from").alias("id", "then"))
    stale = each.join(pages.select("id", "generation").distinct(), "id", "left").where(~F.col("generation").eqNullSafe(F.col("then"))).select("key")
    return young.join(stale.distinct(), "key", "left_anti")


def nearest(cache: DataFrame, query: Sequence[float], knobs: str, least: float = NEAR) -> DataFrame:
    """(key, similarity, results): the cached query nearest to a query vector, if it is near enough; one row at most."""
    rows = cache.where((F.col("knobs") == knobs) & (F.size("vector") == len(query)))
    rows = rows.withColumn("similarity", cosine(F.col("vector"), F.array(*[F.lit(float(x)) for x in query])))
    return rows.where(F.col("similarity") >= least).orderBy(F.desc("similarity"), "key").limit(1).select("key", "similarity", "results")
