"""Markdown trees, JSON lines and change sets as sources and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import fold
from ..operators.documents import front_matter

#: Fixed value: first path segments and the page types they stand for.
PREFIX_TYPES = {"people": "person", "companies": "company", "emails": "email", "notes": "note", "meetings": "meeting", "concepts": "concept", "projects": "project", "code": "code"}
#: Fixed value: folders no reader enters.
SKIPPED = ("node_modules", ".git", "dist", "build", ".obsidian")


def path_slug(path: Column) -> Column:
    """Relative path to slug: lower case, no extension, segments of letters, digits, dots and hyphens."""
    bare = F.regexp_replace(fold(path), r"\.(md|mdx|markdown)$", "")
    return F.regexp_replace(F.regexp_replace(bare, r"[^a-z0-9._/一-鿿-]+", "-"), "-*/-*", "/")


def path_type(path: Column) -> Column:
    first = F.split_part(path, F.lit("/"), F.lit(1))
    out = F.when(F.lit(False), "")
    for prefix, kind in PREFIX_TYPES.items():
        out = out.when(first == prefix, kind)
    return out.otherwise("concept")


def syncable(path: Column) -> Column:
    """Whether a changed path is a document to import."""
    inside = F.lit(True)
    for folder in SKIPPED:
        inside = inside & ~F.concat(F.lit("/"), path).contains(f"/{folder}/")
    return inside & path.rlike(r"\.(md|mdx|markdown)$")


def exclusion(path: Column) -> Column:
    """Why a path is no document to import: its folder or its ending; null for documents."""
    out = F.when(F.lit(False), "")
    for folder in SKIPPED:
        out = out.when(F.concat(F.lit("/"), path).contains(f"/{folder}/"), F.lit(f"in {folder}"))
    return out.when(~path.rlike(r"\.(md|mdx|markdown)$"), "no markdown")


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"\A\s+|\s+\z", "")


def _relative(root: str) -> Column:
    base = root.rstrip("/").removeprefix("file://")
    return F.regexp_replace(F.regexp_replace("path", "^[a-z]+:/*", "/"), f"^{base}/", "")


def markdown_rejects(spark: SparkSession, root: str, most_bytes: int = 5_000_000) -> DataFrame:
    """(path, bytes, reason): the files that ``markdown_tree`` leaves out. No content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select(_relative(root).alias("path"), F.col("length").alias("bytes"))
    reason = F.coalesce(exclusion(F.col("path")), F.when(F.col("bytes") > most_bytes, F.lit(f"more than {most_bytes} bytes")))
    return files.withColumn("reason", reason).where("reason IS NOT NULL")


def markdown_tree(spark: SparkSession, root: str, source_id: str, most_bytes: int = 5_000_000) -> DataFrame:
    """Pages of a folder of markdown files: slug, type, title, body, timeline, content hash.

    Larger files and those of skipped folders are listed by ``markdown_rejects``.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{md,mdx,markdown}").load(root)
    path = _relative(root)
    rows = files.where(F.col("length") <= most_bytes).select(path.alias("path"), F.decode("content", "UTF-8").alias("text"), "modificationTime")
    rows = rows.where(syncable(F.col("path")))
    body = F.regexp_replace("text", r"(?s)\A---\r?\n.*?\r?\n---\s*(?:\r?\n|\z)", "")
    parts = F.split(body, r"(?m)^<!-- timeline -->\s*$", 2)
    return rows.select(
        F.lit(source_id).alias("source_id"), path_slug(F.col("path")).alias("slug"), F.coalesce(front_matter(F.col("text"), "type"), path_type(F.col("path"))).alias("type"),
        F.coalesce(front_matter(F.col("text"), "title"), F.nullif(F.regexp_extract(body, r"(?m)^# +(.*?) *$", 1), F.lit(""))).alias("title"),
        _strip(parts[0]).alias("compiled_truth"), _strip(F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit(""))).alias("timeline"),
        F.sha2(_strip(parts[0]), 256).alias("content_hash"), F.col("modificationTime").alias("updated_at"),
    )


def as_markdown(pages: DataFrame) -> DataFrame:
    """(path, text): pages as markdown files with a head block; ``markdown_tree`` reads them back."""
    head = F.concat(F.lit("---\ntype: "), F.coalesce("type", F.lit("concept")), F.lit("\ntitle: "), F.coalesce("title", F.lit("")), F.lit("\n---\n"))
    tail = F.when(F.coalesce("timeline", F.lit("")) != "", F.concat(F.lit("\n\n<!-- timeline -->\n"), F.col("timeline"))).otherwise(F.lit(""))
    return pages.select(F.concat("slug", F.lit(".md")).alias("path"), F.concat(head, F.coalesce("compiled_truth", F.lit("")), tail).alias("text"))


def export_markdown(pages: DataFrame, root: str) -> None:
    """Write ``as_markdown`` below a local or mounted folder, each executor its own partitions."""

    def write(rows) -> None:
        import os

        for row in rows:
            path = os.path.join(root, row["path"])
            os.makedirs(os.path.dirname(path), exist_ok=True)
            with open(path, "w", encoding="utf-8") as out:
                out.write(row["text"])

    as_markdown(pages).foreachPartition(write)


def _json_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    text = spark.read.text(path).where("trim(value) <> '' AND NOT startswith(trim(value), '#')")
    how = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    return text.select("value", F.from_json("value", f"{schema}, _broken string", how).alias("r"))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON lines; blank lines and # comments are skipped; broken lines are in ``json_rejects``."""
    return _json_rows(spark, path, schema).where("r._broken IS NULL").select("r.*").drop("_broken")


def json_rejects(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(line): the lines that are no JSON of the schema."""
    return _json_rows(spark, path, schema).where("r._broken IS NOT NULL").select(F.col("value").alias("line"))


def change_set(diff: DataFrame) -> DataFrame:
    """(op, path, old_path) of name-status lines: A, M, D, R with a score and C."""
    cells = F.split("value", "\t")
    op = F.substring(cells[0], 1, 1)
    moved = op.isin("R", "C")
    rows = diff.where(F.col("value").rlike(r"^[AMDRC]\d*\t")).select(
        op.alias("op"), F.when(moved, F.try_element_at(cells, F.lit(3))).otherwise(cells[1]).alias("path"), F.when(op == "R", cells[1]).alias("old_path")
    )
    return rows.where(syncable(F.col("path")) | (F.col("op") == "R"))


def apply_changes(pages: DataFrame, changes: DataFrame, new: DataFrame) -> DataFrame:
    """Pages (keyed by slug) after a change set: deleted and renamed ones leave, new versions replace old ones."""
    gone = changes.where("op IN ('D', 'R')").select(path_slug(F.when(F.col("op") == "R", F.col("old_path")).otherwise(F.col("path"))).alias("slug"))
    kept = pages.join(gone.union(new.select("slug")).distinct(), "slug", "left_anti").select(*pages.columns)
    return kept.unionByName(new, allowMissingColumns=True)
