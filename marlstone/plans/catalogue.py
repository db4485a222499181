"""Named queries of the core operators and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import hierarchy
from ..session import materialize
from ..sources.tables import table
from . import documents, extras, forms, graphs, knowledge, lookups, measures, operations, parsing, rankings, searching, streams, texts, writes  # noqa: F401 - they register their queries
from .registry import ORACLES, QUERIES

FLAGSHIP = "hybrid_full"


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Jobs with an existing parent: topmost ancestor and steps up to it; loops get -1 and their smallest id."""
    tree = hierarchy.hierarchy(table(spark, folder, "minion_jobs"), "id", "parent_job_id")
    return tree.where("parent IS NOT NULL").select(
        F.col("id").alias("job_id"), F.col("root").alias("root_id"), F.col("depth").cast("int").alias("tree_depth")
    )


def p5_hierarchy(spark: SparkSession, folder: str) -> DataFrame:
    """Every job: path, depth, root, number of descendants and nested-set range."""
    tree = hierarchy.hierarchy(table(spark, folder, "minion_jobs"), "id", "parent_job_id", paths=True)
    path = F.array_join("path", "/")
    return tree.select("id", "parent", "root", "depth", "descendants", "lft", "rgt", path.alias("path"))


def p5_descendants(spark: SparkSession, folder: str) -> DataFrame:
    """All descendants of every job, listed by nested-set ranges; jobs in or below a loop have none."""
    tree = materialize(hierarchy.hierarchy(table(spark, folder, "minion_jobs"), "id", "parent_job_id"))
    return hierarchy.descendants(tree, tree.where("descendants > 0"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p5_found": p5_found, "p5_hierarchy": p5_hierarchy, "p5_descendants": p5_descendants} | QUERIES


P5_TREE = """
nodes AS (
  SELECT id, CASE WHEN parent IN (SELECT id FROM minion_jobs) THEN parent END AS parent
  FROM (SELECT id, min(parent_job_id) AS parent FROM minion_jobs WHERE id IS NOT NULL GROUP BY id)),
tree AS (
  SELECT id, parent, id AS root, 0 AS depth, CAST(id AS VARCHAR) AS path FROM nodes WHERE parent IS NULL
  UNION ALL
  SELECT n.id, n.parent, t.root, t.depth + 1, t.path || '/' || n.id FROM nodes n JOIN tree t ON n.parent = t.id),
stuck AS (SELECT * FROM nodes WHERE id NOT IN (SELECT id FROM tree)),
ways AS (
  SELECT id AS start, id AS here FROM stuck
  UNION
  SELECT w.start, s.parent FROM ways w JOIN stuck s ON w.here = s.id),
loops AS (  -- a node is on a cycle if its parent can reach it
  SELECT s.id FROM stuck s JOIN ways w ON w.start = s.parent AND w.here = s.id),
looped AS (
  SELECT w.start AS id, s.parent, min(w.here) AS root FROM ways w JOIN loops l ON w.here = l.id JOIN stuck s ON s.id = w.start GROUP BY ALL)"""


def oracle_sql() -> dict[str, str]:
    return ORACLES | {
        "p5_found": f"""WITH RECURSIVE {P5_TREE}
SELECT id AS job_id, root AS root_id, depth AS tree_depth FROM tree WHERE parent IS NOT NULL
UNION ALL SELECT id, root, -1 FROM looped""",
        "p5_hierarchy": f"""WITH RECURSIVE {P5_TREE},
kin AS (SELECT a.id, b.id AS below FROM tree a JOIN tree b ON a.root = b.root AND starts_with(b.path || '/', a.path || '/')),
sized AS (SELECT t.*, k.n FROM tree t JOIN (SELECT id, count(*) AS n FROM kin GROUP BY id) k USING (id)),
offs AS (SELECT id, CASE WHEN parent IS NULL THEN 0 ELSE 1 + coalesce(sum(n) OVER (PARTITION BY parent ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) END AS off FROM sized),
pre AS (SELECT k.below AS id, sum(o.off) AS lft FROM kin k JOIN offs o ON o.id = k.id GROUP BY k.below)
SELECT s.id, s.parent, s.root, CAST(s.depth AS BIGINT) AS depth, s.n - 1 AS descendants, CAST(p.lft AS BIGINT) AS lft, CAST(p.lft + s.n AS BIGINT) AS rgt, s.path
FROM sized s JOIN pre p USING (id)
UNION ALL SELECT id, parent, root, -1, NULL, NULL, NULL, NULL FROM looped""",
        "p5_descendants": f"""WITH RECURSIVE {P5_TREE},
kin AS (SELECT parent AS ancestor, id FROM tree WHERE parent IS NOT NULL UNION ALL SELECT t.parent, k.id FROM kin k JOIN tree t ON t.id = k.ancestor WHERE t.parent IS NOT NULL)
SELECT ancestor, id FROM kin""",
    }
