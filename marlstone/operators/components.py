"""Connected components of an edge table, in rounds of shuffles without driver-side state.

Each round alternates the large-star and small-star steps: every node sends its larger (then its
smaller-or-equal) neighbours to its smallest neighbour. Edge counts never grow beyond the input's
order and a node with very many neighbours is handled by aggregation and an equi-join, which
adaptive skew handling can split.

Defined results: self edges and repeated edges are harmless, edges with a null end are left out; an
empty edge table gives an empty result. The label of a component is its smallest node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (a, b)."""
    if large:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node with an edge to another node."""
    now = materialize(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct())
    while True:
        new = materialize(_star(_star(now, large=True), large=False))
        # finished when every edge points from a node to a centre that has no edge of its own
        centres = new.select(F.col("b").alias("a"))
        fans = new.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").limit(1)
        if not fans.count() and not new.join(centres, "a", "left_semi").limit(1).count():
            break
        now = new
    return new.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        new.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
