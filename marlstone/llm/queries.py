"""Queries of the training-data operators; __spark_entry__ adds them when this subpackage is present."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import vectors
from ..session import materialize
from ..sources.tables import table
from . import chunking, emails, knn, names, neardup, packing, pii, spans, sql, tokens


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    """(field, row_id, text) of all fields that hold free text."""
    pages, chunks = table(spark, folder, "pages"), table(spark, folder, "content_chunks")
    one = lambda df, field: df.select(F.lit(field).alias("field"), F.col("id").alias("row_id"), F.col(field).alias("text"))
    return one(pages, "compiled_truth").union(one(pages, "timeline")).union(one(chunks, "chunk_text"))


def _secret(spark: SparkSession) -> str:
    """The key of the surrogates: a setting of the session, or an example."""
    return spark.conf.get("marlstone.surrogate.key", "example key: set your own")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Personal information in page bodies, timelines and chunks."""
    fit = pii.finder(table(spark, folder, "pages"), table(spark, folder, "given_names"))
    return pii.found(_texts(spark, folder), fit).distinct()


def p1_redacted(spark: SparkSession, folder: str) -> DataFrame:
    """The same texts with every value replaced by its kind and a keyed surrogate."""
    fit = pii.finder(table(spark, folder, "pages"), table(spark, folder, "given_names"))
    return pii.redacted(_texts(spark, folder).where("text IS NOT NULL"), fit, _secret(spark)).distinct()


def p1_audit(spark: SparkSession, folder: str) -> DataFrame:
    """What the redaction of each field leaves in it: no value, no unchanged one, no two with one surrogate."""
    fit = pii.finder(table(spark, folder, "pages"), table(spark, folder, "given_names"))
    return pii.audit(_texts(spark, folder).where("text IS NOT NULL"), fit, _secret(spark))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of pages that say nearly the same: word triples, at least 30 words, similarity 0.7 or more."""
    pages = table(spark, folder, "pages").where("page_kind = 'markdown' AND coalesce(type, '') <> 'email'")
    pairs = neardup.near_pairs(pages, "id", "compiled_truth", width=3, least=30, threshold=0.7, bands=32, rows=3)
    return pairs.select(F.col("a").alias("page_id_a"), F.col("b").alias("page_id_b")).distinct()


def p2_classes(spark: SparkSession, folder: str) -> DataFrame:
    """Each markdown page's near-duplicate class over five-word shingles at 0.8, and its number of links."""
    pages = table(spark, folder, "pages").where("page_kind = 'markdown'")
    return neardup.classes(pages, "id", "compiled_truth").withColumnRenamed("k", "page_id")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of person pages, or of company pages, that stand for the same person or company."""
    pairs = names.same_pairs(table(spark, folder, "pages"), table(spark, folder, "given_names"))
    return pairs.select(F.col("a").alias("page_id_a"), F.col("b").alias("page_id_b"))


def p3_entities(spark: SparkSession, folder: str) -> DataFrame:
    """The entity of each person or company page, named by its most attested reading."""
    return names.entities(table(spark, folder, "pages"), table(spark, folder, "given_names")).withColumnRenamed("id", "page_id").distinct()


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Stored chunks of page bodies that break the contract of the splitter."""
    return chunking.broken_chunks(table(spark, folder, "pages"), table(spark, folder, "content_chunks"))


def p4_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Every page body cut into pieces under the limit."""
    return chunking.chunks(table(spark, folder, "pages").withColumnRenamed("id", "page_id"), "page_id")


def p4_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the pieces of p4_chunks keep the contract of the splitter and cover every body."""
    pages = table(spark, folder, "pages").select("id", "compiled_truth")
    return chunking.audit(pages, chunking.chunks(pages))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of each mail newly written by its sender."""
    return emails.new_lines(table(spark, folder, "pages").where("type = 'email'")).select(F.col("id").alias("page_id"), "line_no")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Chunk pairs of one model with a cosine of 0.9 or more, one among the 5 most similar to the other."""
    near = knn.neighbours(table(spark, folder, "content_chunks"), k=5, least=0.9)
    a, b = F.least("id", "neighbour"), F.greatest("id", "neighbour")
    return near.select(a.alias("chunk_id_a"), b.alias("chunk_id_b")).distinct()


def p7_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """The 5 most similar chunks of one model for every chunk with an id divisible by 50, among all, however similar.

    Exact and in blocks: the curves of p7_found keep together what is very similar, but weak neighbours
    they find only if they look at a third of all rows or more (see the README).
    """
    near = vectors.nearest_of(table(spark, folder, "content_chunks"), F.col("id") % 50 == 0, group="model", k=5)
    return near.select("id", "neighbour", F.round("similarity", 6).alias("similarity"), "rank")


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_ids(table(spark, folder, "documents"))


def p9_bins(spark: SparkSession, folder: str) -> DataFrame:
    """The container of each document (or piece of an oversized one), for each capacity."""
    return packing.filled(table(spark, folder, "documents"), table(spark, folder, "pack_limits"))


def p9_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the containers of p9_bins hold every document, none above its capacity, none cut in vain and no near-duplicates together."""
    documents, limits = table(spark, folder, "documents"), table(spark, folder, "pack_limits")
    grouped = materialize(packing.classes(documents))  # the same classes whoever asks
    return packing.audit(packing.filled(documents, limits, grouped=grouped), documents, limits, grouped=grouped)


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """Maximal stretches of each document that stand in another, in windows of 200 characters."""
    return spans.shared_spans(table(spark, folder, "documents"))


def p10_share(spark: SparkSession, folder: str) -> DataFrame:
    """How much of each document stands in another."""
    return spans.shared_share(table(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_redacted, p1_audit, p2_found, p2_classes, p3_found, p3_entities, p4_found, p4_chunks, p4_audit, p6_found, p7_found, p7_nearest, p8_ids, p9_bins, p9_audit, p10_found, p10_share)}


def oracle_sql() -> dict[str, str]:
    return dict(sql.ORACLES)
