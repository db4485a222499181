"""Parent-child rows to full hierarchies with nested-set ranges.

Subtree sizes are summed upward, siblings get preorder ranges by prefix sums, and the ranges are
added up downward; nodes that never meet a root are in, or hang from, a cycle. Each pass doubles the
distance it covers (after round k a node knows its 2**k-th ancestor), so a chain of depth d needs
log2(d) rounds rather than d. Every round's state is written to the shared folder.

Defined results
- Repeated rows of an id count once; if they name different parents, the smallest parent holds.
- Rows without id are left out. A parent that is null or not an id makes a root.
- A node whose way up enters a cycle (a node that is its own parent included) has ``root`` = the
  smallest id on that cycle, ``depth`` = -1 and no range, size or path.
- An empty table gives an empty result. Further columns of the input are not carried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_col = F.col


def _nodes(df: DataFrame, key: str, parent: str) -> DataFrame:
    """(id, parent): one row per node, parent null for roots."""
    rows = df.select(_col(key).alias("id"), _col(parent).alias("parent")).where("id IS NOT NULL")
    nodes = rows.groupBy("id").agg(F.min("parent").alias("parent"))
    known = nodes.select(_col("id").alias("parent"), F.lit(True).alias("known"))
    return nodes.join(known, "parent", "left").select("id", F.expr("IF(known, parent, NULL)").alias("parent"))


def _climb(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame], int]:
    """Doubling upward: the final state, each round's 2**k-th ancestors, the number left unresolved.

    State: anc (2**k-th ancestor, null once the root is passed), top and depth (highest node met and
    the steps to it), size (nodes below within 2**k - 1 levels, and itself).
    """
    state = materialize(
        nodes.select(
            "id", _col("parent"), _col("parent").alias("anc"), F.coalesce("parent", "id").alias("top"),
            F.when(_col("parent").isNotNull(), 1).otherwise(0).cast("long").alias("depth"), F.lit(1).cast("decimal(38,0)").alias("size"),
        )
    )
    rounds: list[DataFrame] = []
    left = state.where("anc IS NOT NULL").count()
    while left:
        active = state.where("anc IS NOT NULL")
        rounds.append(active.select("id", "anc"))
        above = state.select(
            _col("id").alias("anc"), _col("anc").alias("a_anc"), _col("top").alias("a_top"), _col("depth").alias("a_depth")
        )
        below = active.groupBy("anc").agg(F.sum("size").alias("more")).withColumnRenamed("anc", "id")
        moved = state.join(above, "anc", "left").select(
            "id", "parent", _col("a_anc").alias("anc"), F.coalesce("a_top", "top").alias("top"),
            (_col("depth") + F.coalesce("a_depth", F.lit(0))).alias("depth"), "size",
        )
        grown = moved.join(below, "id", "left").select(
            "id", "parent", "anc", "top", "depth",
            # sizes around a cycle double for ever; they are never used, so let them not overflow
            F.least(_col("size") + F.coalesce("more", F.lit(0)), F.expr("CAST(1e30 AS DECIMAL(38,0))")).cast("decimal(38,0)").alias("size"),
        )
        state = materialize(grown)
        now = state.where("anc IS NOT NULL").count()
        if now == left:  # every finite chain resolves some node in each round
            break
        left = now
    return state, rounds, left


def _sibling_offsets(resolved: DataFrame) -> DataFrame:
    """(id, off): distance of each node's preorder number from its parent's; siblings in id order.

    Children are range-partitioned by (parent, id), so a parent with very many children is spread
    over several partitions; prefix sums are taken inside a partition, then over partition totals.
    """
    placed = materialize(
        resolved.where("parent IS NOT NULL")
        .select("id", "parent", _col("size").cast("long").alias("size"))
        .repartitionByRange("parent", "id")
        .withColumn("part", F.spark_partition_id())
    )
    totals = placed.groupBy("parent", "part").agg(F.sum("size").alias("total"))
    before = Window.partitionBy("parent").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("parent", "part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("parent", "part").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return local.join(starts, ["parent", "part"]).select("id", (1 + _col("ahead") + _col("start")).alias("off"))


def _cycles(unresolved: DataFrame, count: int) -> DataFrame:
    """(id, root): smallest id on the cycle that each unresolved node's way up enters."""
    state = materialize(unresolved.select("id", _col("parent").alias("jump"), _col("id").alias("low")))
    reach = 1
    while reach < count:
        above = state.select(_col("id").alias("jump"), _col("jump").alias("a_jump"), _col("low").alias("a_low"))
        state = materialize(
            state.join(above, "jump").select("id", _col("a_jump").alias("jump"), F.least("low", "a_low").alias("low"))
        )
        reach *= 2
    on_cycle = state.select(_col("id").alias("jump"), _col("low").alias("root"))
    return state.join(on_cycle, "jump").select("id", "root")


def hierarchy(df: DataFrame, key: str, parent: str, paths: bool = False) -> DataFrame:
    """One row for each node: id, parent (null for roots), root, depth, descendants, lft, rgt[, path].

    ``lft`` and ``rgt`` are preorder numbers inside the root's tree: u is v or an ancestor of v if
    and only if they have one root and u.lft <= v.lft < u.rgt. ``path`` is the array of ids from the
    root to the node.
    """
    state, rounds, left = _climb(_nodes(df, key, parent))
    resolved, unresolved = state.where("anc IS NULL"), state.where("anc IS NOT NULL")
    offsets = _sibling_offsets(resolved)
    walk = materialize(
        resolved.join(offsets, "id", "left").select(
            "id", F.coalesce("off", F.lit(0)).cast("long").alias("lft"), *([F.array("id").alias("path")] if paths else [])
        )
    )
    for ancestors in rounds:
        step = ancestors.join(walk.select(_col("id").alias("anc"), _col("lft").alias("a_lft"), *([_col("path").alias("a_path")] if paths else [])), "anc").drop("anc")
        walk = materialize(
            walk.join(step, "id", "left").select(
                "id", (_col("lft") + F.coalesce("a_lft", F.lit(0))).alias("lft"),
                *([F.when(_col("a_path").isNull(), _col("path")).otherwise(F.concat("a_path", "path")).alias("path")] if paths else []),
            )
        )
    whole = resolved.join(walk, "id").select(
        "id", "parent", _col("top").alias("root"), "depth", (_col("size") - 1).cast("long").alias("descendants"), "lft",
        (_col("lft") + _col("size")).cast("long").alias("rgt"), *(["path"] if paths else []),
    )
    if not left:
        return whole
    looped = unresolved.select("id", "parent").join(_cycles(unresolved, left), "id")
    return whole.unionByName(looped.withColumn("depth", F.lit(-1).cast("long")), allowMissingColumns=True)


def ancestry(tree: DataFrame) -> DataFrame:
    """(ancestor, id, distance): every node with each of its ancestors, from the paths of ``hierarchy``."""
    steps = tree.where("path IS NOT NULL").select("id", "depth", F.posexplode("path").alias("at", "ancestor"))
    return steps.where("at < depth").select("ancestor", "id", (_col("depth") - _col("at")).alias("distance"))


def descendants(tree: DataFrame, wanted: DataFrame, key: str = "id", bin_size: int = 64) -> DataFrame:
    """(ancestor, id): all descendants of the nodes of ``wanted``, by nested-set ranges.

    Preorder numbers are cut into bins: a node stands in one, a range goes to each it overlaps, so a
    tree of any size is spread over tasks and a node meets few ranges that do not hold it. Ranges make
    no more rows than a ``bin_size``-th of the result and one or two each. Nested wanted nodes repeat
    their common descendants, as asked for; a node outside any wanted range meets no row.
    """
    placed = tree.where("lft IS NOT NULL")
    ranges = wanted.select(_col(key).alias("ancestor")).distinct().join(
        placed.where("rgt > lft + 1").select(_col("id").alias("ancestor"), "root", _col("lft").alias("a"), _col("rgt").alias("z")), "ancestor"
    )
    number = lambda c: F.floor(c / bin_size)
    over = ranges.withColumn("bin", F.explode(F.sequence(number(_col("a") + 1), number(_col("z") - 1))))
    nodes = placed.select("id", "root", "lft", number(_col("lft")).alias("bin"))
    return nodes.join(over.hint("merge"), ["root", "bin"]).where("lft > a AND lft < z").select("ancestor", "id")
