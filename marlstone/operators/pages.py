"""Scans, filters and upserts of pages, chunks and jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sort orders of page listings; the id breaks ties.
ORDERS = {
    "updated_desc": lambda: [F.desc_nulls_last("updated_at"), F.asc("id")],
    "updated_asc": lambda: [F.asc_nulls_last("updated_at"), F.asc("id")],
    "created_desc": lambda: [F.desc_nulls_last("created_at"), F.asc("id")],
    "slug": lambda: [F.asc("slug"), F.asc("id")],
}


def visible(pages: DataFrame, sources: DataFrame) -> DataFrame:
    """Pages that searches may show: not deleted, not quarantined, source not archived.

    ``sources`` is a catalogue of some dozens of rows; the optimiser broadcasts it by its size.
    """
    open_sources = sources.where("NOT coalesce(archived, false)").select(F.col("id").alias("source_id"))
    quarantined = F.coalesce(F.get_json_object("frontmatter", "$.quarantined"), F.lit("false"))
    return pages.where(F.col("deleted_at").isNull() & (quarantined != "true")).join(open_sources, "source_id", "left_semi")


def listed(
    pages: DataFrame, types: Sequence[str] | None = None, updated_after: str | None = None, prefix: str | None = None, without: Sequence[str] = (),
    order: str = "updated_desc", limit: int = 20, offset: int = 0,
) -> DataFrame:
    """A page of a listing: optional filters, one of the fixed orders, at most 100 rows."""
    if types:
        pages = pages.where(F.col("type").isin(list(types)))
    if updated_after:
        pages = pages.where(F.col("updated_at") > F.lit(updated_after).cast("timestamp"))
    if prefix:
        pages = pages.where(F.col("slug").startswith(prefix))
    for start in without:
        pages = pages.where(~F.col("slug").startswith(start))
    return pages.orderBy(*ORDERS[order]()).offset(offset).limit(min(max(limit, 1), 100))


def first_of(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group (DISTINCT ON)."""
    at = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("__at", F.row_number().over(at)).where("__at = 1").drop("__at")


def upserted(target: DataFrame, rows: DataFrame, key: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Target with rows merged by key: new keys are added, known ones replaced; null never overwrites ``keep`` columns."""
    new = rows.select(*[F.col(c).alias(c if c in key else f"__new_{c}") for c in rows.columns], F.lit(True).alias("__hit"))
    joined = target.withColumn("__old", F.lit(True)).join(new, list(key), "full_outer")
    value = lambda c: F.coalesce(f"__new_{c}", c) if c in keep else F.when(F.col("__hit"), F.col(f"__new_{c}")).otherwise(F.col(c))
    return joined.select(*[F.col(c) if c in key or c not in rows.columns else value(c).alias(c) for c in target.columns])


def insert_ignore(target: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Target and those of rows whose key it lacks; of rows with one key any one is added; null keys are equal."""
    match = F.lit(True)
    for c in key:
        match = match & target[c].eqNullSafe(rows[c])
    return target.unionByName(rows.join(target, match, "left_anti").dropDuplicates(list(key)), allowMissingColumns=True)


def soft_deleted(pages: DataFrame, doomed: DataFrame, at: str, key: Sequence[str] = ("source_id", "slug")) -> DataFrame:
    """Pages with deleted_at set where the key is in doomed and it was not set before."""
    marks = doomed.select(*key).distinct().withColumn("__gone", F.lit(True))
    hit = F.col("__gone") & F.col("deleted_at").isNull()
    return pages.join(marks, list(key), "left").withColumn("deleted_at", F.when(hit, F.lit(at).cast("timestamp")).otherwise(F.col("deleted_at"))).drop("__gone").select(*pages.columns)


def purged(pages: DataFrame, before: str) -> DataFrame:
    """Pages without those soft-deleted before a moment."""
    return pages.where(F.col("deleted_at").isNull() | (F.col("deleted_at") >= F.lit(before).cast("timestamp")))


def stale_chunk(signature: str | None = None) -> Column:
    """Chunks to embed (again): without a vector, or of another model."""
    stale = F.col("embedding").isNull()
    return stale | (F.col("model") != signature) if signature else stale


def stale_extraction(version_at: str) -> Column:
    """Pages whose links must be extracted again."""
    done = F.col("links_extracted_at")
    return done.isNull() | (F.col("updated_at") > done) | (done < F.lit(version_at).cast("timestamp"))
