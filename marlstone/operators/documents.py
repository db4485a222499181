"""Parsing markdown, chat logs and embedded tables into rows, inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The shapes of a chat line, each with time, speaker and text.
CHAT_LINES = {
    "bracket": r"^\[(\d{1,2}:\d{2}(?::\d{2})?)\] ([^:\n]{1,60}): (.*)$",
    "dash": r"^(\d{1,2}:\d{2}(?::\d{2})?) - ([^:\n]{1,60}): (.*)$",
    "bold": r"^\*\*([^*\n]{1,60})\*\* \((\d{1,2}:\d{2})\): (.*)$",
}


def lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_no from 0, line): one row for each line, without its line end."""
    return df.where(F.col(text).isNotNull()).select(key, F.posexplode(F.split(text, "\r?\n")).alias("line_no", "line"))


def chat_turns(df: DataFrame, key: str, text: str, shape: str = "bracket") -> DataFrame:
    """(key, turn from 1, at, speaker, said): a matching line begins a turn, others continue it.

    Lines before the first turn belong to none.
    """
    pattern = CHAT_LINES[shape]
    time, speaker = (2, 1) if shape == "bold" else (1, 2)
    begins = F.col("line").rlike(pattern)
    running = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    marked = lines(df, key, text).withColumn("turn", F.sum(begins.cast("int")).over(running)).where("turn > 0")
    part = F.when(begins, F.regexp_extract("line", pattern, 3)).otherwise(F.col("line"))
    grouped = marked.groupBy(key, "turn").agg(
        F.min_by("line", "line_no").alias("head"), F.array_sort(F.collect_list(F.struct("line_no", part.alias("p")))).alias("parts")
    )
    said = F.regexp_replace(F.array_join(F.transform("parts", lambda p: p["p"]), "\n"), r"\s+\z", "")
    return grouped.select(key, "turn", F.regexp_extract("head", pattern, time).alias("at"), F.regexp_extract("head", pattern, speaker).alias("speaker"), said.alias("said"))


def front_matter(text: Column, field: str) -> Column:
    """A one-line field of the block between --- lines at the head of a text; null without block or field."""
    block = F.regexp_extract(text, r"(?s)\A---\r?\n(.*?)\r?\n---\s*(?:\r?\n|\z)", 1)
    found = F.regexp_extract(block, rf"(?m)^{field}:[ \t]*(.*?)[ \t\r]*$", 1)
    return F.when(found != "", found)


def headings(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_no, level, heading): the outline of each text."""
    shape = r"^(#{1,6}) +(.*?) *$"
    found = lines(df, key, text).where(F.col("line").rlike(shape))
    return found.select(key, "line_no", F.length(F.regexp_extract("line", shape, 1)).alias("level"), F.regexp_extract("line", shape, 2).alias("heading"))


def table_rows(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_no, cells): rows of pipe tables, without the rule below the heads."""
    found = lines(df, key, text).withColumn("line", F.trim("line")).where(F.col("line").rlike(r"^\|.*\|$") & ~F.col("line").rlike(r"^\|[ :|-]+\|$"))
    inner = F.expr("substring(line, 2, length(line) - 2)")
    return found.select(key, "line_no", F.transform(F.split(inner, r"\|"), lambda c: F.trim(c)).alias("cells"))


def timeline_rows(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, day, source, summary) of lines like ``- **2024-10-28** | meeting — what happened``."""
    shape = r"^- \*\*(\d{4}-\d{2}-\d{2})\*\* \| ([^—\n]*?) — (.*)$"
    found = lines(df, key, text).where(F.col("line").rlike(shape))
    part = lambda i: F.regexp_extract("line", shape, i)
    return found.select(key, F.try_to_timestamp(part(1), F.lit("yyyy-MM-dd")).cast("date").alias("day"), part(2).alias("source"), part(3).alias("summary")).where("day IS NOT NULL")
