"""Boosts, deduplication layers and decays behind a ranking."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scores
from ..session import materialize
from . import search

#: Days after which a fact of a kind counts half as a decay constant.
HALF_LIVES = {"meeting": 30.0, "note": 90.0, "email": 14.0, "project": 180.0, "person": 365.0, "company": 365.0}
#: Words that tell what a question is after, in the order they are tried.
INTENTS = (
    ("temporal", r"\b(when|since|until|latest|recent|yesterday|today|last (week|month|year)|timeline|history)\b"),
    ("event", r"\b(meeting|call|offsite|launch|retro|review|workshop|demo)\b"),
    ("entity", r"\b(who|company|person|team|founder|customer|vendor|landlord)\b"),
)


def boosted(base: Column, backlinks: Column, age: Column, title_hit: Column, alias_hit: Column, recency: float = 1.0) -> Column:
    """A base score with its ordered boosts: backlinks, recency, title phrase, alias."""
    return base * scores.backlink_boost(backlinks) * (1 + F.lit(recency) * scores.hyperbolic(age, 30.0, 0.3)) * F.when(title_hit, 1.25).otherwise(1.0) * F.when(alias_hit, 1.05).otherwise(1.0)


def intent(text: Column) -> Column:
    """The first intent whose words stand in a text, else general."""
    low = F.lower(text)
    out = F.when(F.lit(False), "")
    for name, words in INTENTS:
        out = out.when(low.rlike(words), name)
    return out.otherwise("general")


def confidence(base: Column, age: Column, kind: Column) -> Column:
    """base * exp(-age / half-life of the kind), between 0 and 1."""
    half = F.when(F.lit(False), 0.0)
    for name, days in HALF_LIVES.items():
        half = half.when(kind == name, days)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), base * F.exp(-F.greatest(age, F.lit(0.0)) / half.otherwise(60.0))))


def unlike_only(df: DataFrame, by: str, text: str, most: float = 0.85, order: Sequence[str] = ("score", "id")) -> DataFrame:
    """Rows of each group (one query's results) without those too like a better one: greedy Jaccard over words."""
    words = re.compile(r"\w+")

    def keep(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(list(order), ascending=[False] + [True] * (len(order) - 1))
        kept, sets = [], []
        for place, value in zip(frame.index, frame[text]):
            own = set(words.findall((value or "").lower()))
            if all(len(own & s) <= most * len(own | s) for s in sets if own | s):
                kept.append(place)
                sets.append(own)
        return frame.loc[kept]

    return df.groupBy(by).applyInPandas(keep, df.schema)


def layered(df: DataFrame, page: str, kind: str, limit: int, share: float = 0.6, first: int = 3, last: int = 2) -> DataFrame:
    """Result layers: ``first`` chunks a page, a cap on each type's share of the head, ``last`` chunks a page."""
    some = search.best_per(df, [page], first)
    mixed = search.capped_share(some, kind, share, limit, "id")
    return search.best_per(mixed, [page], last)


def clusters(df: DataFrame, by: str, vector: str, order: str, least: float = 0.85) -> DataFrame:
    """(by, id, head): greedy single-pass clustering inside each group, newest first: a row joins the first head alike enough."""
    import numpy as np

    kind = df.schema["id"].dataType.simpleString()
    by_kind = df.schema[by].dataType.simpleString()

    def assign(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values([order, "id"], ascending=[False, True])
        heads, rows, out = [], np.zeros((0, 0)), []
        for key, value in zip(frame["id"], frame[vector]):
            unit = np.asarray(value, dtype=float)
            unit = unit / (np.linalg.norm(unit) or 1.0)
            like = rows @ unit if len(heads) else np.array([])
            hit = np.flatnonzero(like >= least)
            if len(hit):
                out.append(heads[hit[0]])
            else:
                rows = unit[None] if not heads else np.vstack([rows, unit])
                heads.append(key)
                out.append(key)
        return pd.DataFrame({by: frame[by], "id": frame["id"], "head": out})

    return df.select(by, "id", vector, order).groupBy(by).applyInPandas(assign, f"{by} {by_kind}, id {kind}, head {kind}")


def word_windows(df: DataFrame, key: str, text: str, size: int = 300, overlap: int = 50) -> DataFrame:
    """(key, part from 0, words): overlapping word windows; the last one ends with the text. All inside the JVM."""
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    step = size - overlap
    rows = df.select(key, words.alias("w")).where("size(w) > 0")
    parts = F.greatest(F.lit(0), F.ceil((F.size("w") - size) / step)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), parts), lambda i: F.struct(i.alias("part"), F.slice(F.col("w"), i * step + 1, F.lit(size)).alias("words")))
    return rows.select(key, F.explode(cut).alias("p")).select(key, "p.part", "p.words")


def redacted(text: Column) -> Column:
    """Emails, bearer tokens, dashed social security numbers and card numbers replaced by their kind."""
    for pattern, label in (
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "[email]"), (r"\beyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", "[token]"),
        (r"(?i)\bbearer [A-Za-z0-9._-]{8,}", "[token]"), (r"\b\d{3}-\d{2}-\d{4}\b", "[ssn]"), (r"\b\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}\b", "[card]"),
    ):
        text = F.regexp_replace(text, pattern, label)
    return text


def batches(df: DataFrame, size: int, order: Sequence[str]) -> Iterator[DataFrame]:
    """Keyset pagination: frames of up to ``size`` rows in order.

    The table is sorted once, range by range, and written with the number of each row's frame; each
    frame is a pruned read of it.
    """
    number = "__number"
    placed = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id()))
    sizes = {r["__part"]: (r["n"], r["low"]) for r in placed.groupBy("__part").agg(F.count("*").alias("n"), F.min("__at").alias("low")).collect()}  # one row a partition
    start, shift = 0, F.lit(None).cast("bigint")
    for part in sorted(sizes):
        n, low = sizes[part]
        shift = F.when(F.col("__part") == part, F.lit(start - low)).otherwise(shift)
        start += n
    framed = materialize(placed.withColumn(number, F.floor((F.col("__at") + shift) / size)).drop("__part", "__at"))
    for i in range(-(-start // size)):
        yield framed.where(F.col(number) == i).drop(number)
