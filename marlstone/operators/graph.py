"""Operators over the typed link graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def edges(links: DataFrame) -> DataFrame:
    """Distinct (src, dst, link_type, link_source) edges."""
    return links.select(F.col("from_page_id").alias("src"), F.col("to_page_id").alias("dst"), "link_type", "link_source").distinct()


def in_degree(nodes: DataFrame, links: DataFrame, without_type: str | None = "mentions") -> DataFrame:
    """(id, backlinks) of all nodes, zero-filled; edges of one type may be left out (null-safe)."""
    found = edges(links)
    if without_type:
        found = found.where(~F.col("link_type").eqNullSafe(without_type))
    counts = found.groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("backlinks"))
    return nodes.select("id").distinct().join(counts, "id", "left").select("id", F.coalesce("backlinks", F.lit(0)).alias("backlinks"))


def orphans(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """Live nodes without an inbound edge from another live node."""
    live = nodes.where("deleted_at IS NULL").select("id").distinct()
    inbound = edges(links).where("src <> dst").join(live.withColumnRenamed("id", "src"), "src", "left_semi").select(F.col("dst").alias("id"))
    return live.join(inbound, "id", "left_anti")


def unreciprocated(links: DataFrame, link_type: str) -> DataFrame:
    """Edges of a type whose reverse of the same type is missing."""
    one = edges(links).where(F.col("link_type") == link_type).select("src", "dst").distinct()
    return one.join(one.select(F.col("dst").alias("src"), F.col("src").alias("dst")), ["src", "dst"], "left_anti")


def fan_out(seeds: DataFrame, links: DataFrame, depth: int = 3, link_types: list[str] | None = None) -> DataFrame:
    """(id, hop): nodes within ``depth`` steps along the edges, with the least number of steps.

    Breadth first: each round joins only the last frontier and drops what was met before.
    """
    step = edges(links)
    if link_types:
        step = step.where(F.col("link_type").isin(link_types))
    step = step.select("src", "dst").where("src <> dst").distinct()
    met = frontier = materialize(seeds.select(F.col("id").cast("int").alias("id")).distinct().withColumn("hop", F.lit(0)))
    for hop in range(1, depth + 1):
        reached = frontier.join(step, frontier["id"] == step["src"]).select(F.col("dst").alias("id")).distinct()
        frontier = materialize(reached.join(met, "id", "left_anti").withColumn("hop", F.lit(hop)))
        met = met.unionByName(frontier)
    return met


def common_targets(seeds: DataFrame, links: DataFrame) -> DataFrame:
    """(id, seeds): nodes that several seeds link to, most first."""
    step = edges(links).select("src", "dst").distinct()
    hit = step.join(seeds.select(F.col("id").alias("src")).distinct(), "src", "left_semi")
    return hit.groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("seeds")).where("seeds > 1")


def induced_degree(members: DataFrame, links: DataFrame) -> DataFrame:
    """(id, inside, sources): links among the members, and how many other sources they come from."""
    who = members.select("id", "source_id").distinct()
    pairs = edges(links).select("src", "dst").where("src <> dst").distinct()
    kept = pairs.join(who.select(F.col("id").alias("src"), F.col("source_id").alias("from_source")), "src").join(
        who.select(F.col("id").alias("dst"), F.col("source_id").alias("to_source")), "dst"
    )
    other = F.when(F.col("from_source") != F.col("to_source"), F.col("from_source"))
    return kept.groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("inside"), F.countDistinct(other).alias("sources"))
