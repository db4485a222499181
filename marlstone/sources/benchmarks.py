"""Judgements, baselines and chat benchmarks as sources, each with its schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import json_lines

QRELS = "query_id string, query string, relevant array<struct<source_id:string,slug:string>>, expected_top1 struct<source_id:string,slug:string>"
BASELINE = "query string, tool string, retrieved array<string>, latency_ms double"
SESSIONS = "question_id string, question string, answer string, sessions array<struct<session_id:string,date:string,turns:array<struct<role:string,content:string>>>>"


def qrels(spark: SparkSession, path: str) -> DataFrame:
    """(query_id, query, source_id, slug, top): one row a judged page."""
    rows = json_lines(spark, path, QRELS)
    each = rows.select("query_id", "query", "expected_top1", F.explode("relevant").alias("r"))
    top = F.coalesce((F.col("expected_top1.source_id") == F.col("r.source_id")) & (F.col("expected_top1.slug") == F.col("r.slug")), F.lit(False))
    return each.select("query_id", "query", "r.source_id", "r.slug", top.alias("top"))


def baseline(spark: SparkSession, path: str) -> DataFrame:
    """Recorded results of queries."""
    return json_lines(spark, path, BASELINE)


def chat_pages(spark: SparkSession, path: str) -> DataFrame:
    """(question_id, slug, date, compiled_truth): one page a session of a chat benchmark, its turns as lines."""
    rows = json_lines(spark, path, SESSIONS).select("question_id", F.explode("sessions").alias("s"))
    lines = F.transform("s.turns", lambda t: F.concat(F.lit("**"), t["role"], F.lit(":** "), t["content"]))
    slug = F.concat(F.lit("chat/"), F.lower("question_id"), F.lit("/"), F.lower("s.session_id"))
    return rows.select("question_id", slug.alias("slug"), F.to_date("s.date").alias("date"), F.array_join(lines, "\n").alias("compiled_truth"))


def replayed(was: DataFrame, now: DataFrame) -> DataFrame:
    """(query, jaccard, same_top, slower): how recorded results of queries compare with those of now."""
    new = now.select("query", F.col("retrieved").alias("n"), F.col("latency_ms").alias("ms"))
    both = was.join(new, "query")
    union = F.size(F.array_union("retrieved", "n"))
    return both.select(
        "query", F.when(union > 0, F.size(F.array_intersect("retrieved", "n")) / union).otherwise(1.0).alias("jaccard"),
        F.try_element_at("retrieved", F.lit(1)).eqNullSafe(F.try_element_at("n", F.lit(1))).alias("same_top"), F.when(F.col("latency_ms") > 0, F.col("ms") / F.col("latency_ms")).alias("slower"),
    )
