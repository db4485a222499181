"""Time series, cohorts, claims and their calibration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def daily(events: DataFrame, by: Sequence[str], at: str = "ts") -> DataFrame:
    """(by…, day, n): events of each day."""
    return events.groupBy(*by, F.col(at).cast("date").alias("day")).agg(F.count("*").alias("n"))


def gap_filled(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """The same with zero rows for days without events, from the first to the last day of all.

    The calendar is a sequence exploded per cohort; nothing is crossed with the events.
    """
    span = counts.agg(F.min("day").alias("first"), F.max("day").alias("last"))
    cohorts = counts.select(*by).distinct().crossJoin(F.broadcast(span))  # one row
    grid = cohorts.select(*by, F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 DAY"))).alias("day"))
    return grid.join(counts, [*by, "day"], "left").select(*by, "day", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


def anomalies(counts: DataFrame, by: Sequence[str], sigma: float = 3.0) -> DataFrame:
    """Days above mean + sigma sample deviations of the cohort's other days; above mean + 1 where these never vary."""
    whole = Window.partitionBy(*by)
    n, total, squares = F.count("*").over(whole) - 1, F.sum("n").over(whole) - F.col("n"), F.sum(F.col("n") * F.col("n")).over(whole) - F.col("n") * F.col("n")
    mean = total / n
    spread = F.sqrt(F.greatest((squares - n * mean * mean) / (n - 1), F.lit(0.0)))
    out = counts.withColumn("others", n).withColumn("mean", mean).withColumn("spread", spread).where("others > 1").drop("others")
    return out.where(F.when(F.col("spread") < 1e-9, F.col("n") > F.col("mean") + 1).otherwise(F.col("n") > F.col("mean") + sigma * F.col("spread")))


def regressions(series: DataFrame, by: Sequence[str], value: str, order: Sequence[str], drop: float = 0.10) -> DataFrame:
    """Points at least ``drop`` below the point before them."""
    before = F.lag(value).over(Window.partitionBy(*by).orderBy(*order))
    return series.withColumn("before", before).where((F.col("before") > 0) & ((F.col(value) - F.col("before")) / F.col("before") <= -drop))


def scorecard(claims: DataFrame, by: Sequence[str]) -> DataFrame:
    """Resolved claims of each group: counts by outcome, hit rate, Brier score over the binary ones.

    claims: weight from 0 to 1, outcome in (correct, incorrect, partial) or null.
    """
    hit = F.when(F.col("outcome") == "correct", 1.0).when(F.col("outcome") == "incorrect", 0.0)
    return claims.groupBy(*by).agg(
        F.count("*").alias("claims"), F.count("outcome").alias("resolved"), F.count_if(F.col("outcome") == "correct").alias("correct"),
        F.count_if(F.col("outcome") == "partial").alias("partial"), F.avg(hit).alias("hit_rate"), F.avg(F.pow(F.col("weight") - hit, 2)).alias("brier"),
    )


def calibration(claims: DataFrame, buckets: int = 10) -> DataFrame:
    """(bucket, n, predicted, observed) of binary claims over equal widths; the last bucket takes 1.0."""
    binary = claims.where("outcome IN ('correct', 'incorrect')")
    at = F.least(F.floor(F.col("weight") * buckets), F.lit(buckets - 1)).cast("int")
    return binary.groupBy(at.alias("bucket")).agg(
        F.count("*").alias("n"), F.avg("weight").alias("predicted"), F.avg(F.when(F.col("outcome") == "correct", 1.0).otherwise(0.0)).alias("observed")
    )


def sessions(events: DataFrame, by: str, at: Column, gap_seconds: int) -> DataFrame:
    """Events with the number of their session: a new one begins after a gap."""
    order = Window.partitionBy(by).orderBy("__s", "event_id")
    out = events.withColumn("__s", at).withColumn("__new", (F.col("__s") - F.lag("__s").over(order) > gap_seconds).cast("int"))
    return out.withColumn("session", F.sum(F.coalesce("__new", F.lit(0))).over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("__s", "__new")


def lagged(df: DataFrame, by: Sequence[str], place: str, tie: str, value: str, out: str, block: int = 256) -> DataFrame:
    """df with the value of the row before, in the order of (place, tie), null for a group's first row.

    Rows are ordered inside blocks of places; a block's first row takes the last value of the block
    before, so no group is gathered in one task.
    """
    rows = df.withColumn("__block", F.floor(F.col(place) / block))
    last = rows.groupBy(*by, "__block").agg(F.max_by(value, F.struct(place, tie)).alias("__last"))
    before = last.select(*by, "__block", F.lag("__last").over(Window.partitionBy(*by).orderBy("__block")).alias("__before"))
    inside = F.lag(value).over(Window.partitionBy(*by, "__block").orderBy(place, tie))
    first = F.row_number().over(Window.partitionBy(*by, "__block").orderBy(place, tie)) == 1
    return rows.join(before, [*by, "__block"]).withColumn(out, F.when(first, F.col("__before")).otherwise(inside)).drop("__block", "__before")


def counted_within(df: DataFrame, by: Sequence[str], at: Column, width: int, out: str) -> DataFrame:
    """df with the number of rows of its group from ``width`` before a row's moment to that moment.

    Each row goes to the stretch of time it lies in and, as context, to the next one; frames are taken
    inside (group, stretch), so a group is spread over its time. Rows without a moment count together.
    """
    rows = df.withColumn("__at", at).withColumn("__own", F.floor(F.col("__at") / width))
    both = rows.withColumn("__in", F.explode(F.array("__own", F.col("__own") + 1)))
    both = both.where(F.col("__own").isNotNull()).unionByName(rows.where("__own IS NULL").withColumn("__in", F.col("__own")))
    frame = Window.partitionBy(*by, "__in").orderBy("__at").rangeBetween(-width, 0)
    return both.withColumn(out, F.count("*").over(frame)).where(F.col("__in").eqNullSafe(F.col("__own"))).drop("__at", "__own", "__in")
