"""Payloads within a budget, and texts rewritten alike through a session."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def grouped(df: DataFrame, by: str, cost: str, budget: int, order: str) -> DataFrame:
    """df with the number of the group each row of ``by`` falls into, by running sums of costs.

    A group begins where the running sum passes a multiple of the budget, so groups stay within two
    budgets less one row, and no row is left out; a costly row alone makes a group too large.
    """
    running = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("group", F.floor((F.sum(cost).over(running) - F.col(cost)) / budget).cast("int"))


def summarised(groups: DataFrame, by: str, text: str, lead: int = 120) -> DataFrame:
    """(by, group, rows, summary): the beginnings of each group's texts, in order of the texts."""
    heads = F.array_sort(F.collect_list(F.substring(text, 1, lead)))
    return groups.groupBy(by, "group").agg(F.count("*").alias("rows"), F.array_join(heads, " … ").alias("summary"))


def rewritten(df: DataFrame, session: str, text: str, secret: str) -> DataFrame:
    """df with slugs and amounts in a text replaced alike through each session.

    A slug of two segments keeps its first one and gets a keyed second one; an amount of money is scaled
    by a keyed factor of its session between a half and three halves, so sums keep their proportions.
    """
    spans = F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(r"\b((?:people|companies|projects|concepts|meetings|notes)/[a-z0-9][a-z0-9-]*)"), 1))
    # long slugs first, so that none is taken for the beginning of another
    ordered = F.array_sort(spans, lambda a, b: F.when(F.length(a) > F.length(b), -1).when(F.length(a) < F.length(b), 1).otherwise(F.when(a < b, -1).when(a > b, 1).otherwise(0)))
    key = lambda x: F.substring(F.sha2(F.concat_ws("|", F.lit(secret), F.col(session).cast("string"), x), 256), 1, 10)
    new = F.aggregate(ordered, F.col(text), lambda s, x: F.replace(s, x, F.concat(F.split_part(x, F.lit("/"), F.lit(1)), F.lit("/x-"), key(x))))
    factor = 0.5 + F.conv(F.substring(key(F.lit("money")), 1, 6), 16, 10).cast("double") / (16**6)
    amounts = F.array_distinct(F.regexp_extract_all(new, F.lit(r"(\$\d+(?:\.\d\d)?)\b"), 1))

    def scaled(x: Column) -> Column:
        return F.concat(F.lit("$"), F.format_string("%.2f", F.substring(x, 2, 40).cast("double") * factor))

    # through a mark, so that no new amount is taken for an old one
    marked = F.aggregate(amounts, new, lambda s, x: F.regexp_replace(s, F.concat(F.lit(r"\Q"), x, F.lit(r"\E(?![\d.])")), F.concat(F.lit("\u0001"), F.substring(scaled(x), 2, 40))))
    return df.withColumn(text, F.replace(marked, F.lit("\u0001"), F.lit("$")))
