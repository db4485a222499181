"""Aggregates over claims, facts, runs and captured queries; all combine before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What a resolved claim came to: 1, 0, or nothing that counts.
OUTCOME = lambda quality: F.when(quality == "correct", 1.0).when(quality == "incorrect", 0.0)


def brier(weight: Column, quality: Column) -> Column:
    """Mean squared error of weights against binary outcomes; others do not count."""
    return F.avg(F.pow(weight - OUTCOME(quality), 2))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, null for an empty whole."""
    return F.when(whole > 0, part / whole)


def scorecard(claims: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by…, claims, resolved, correct, incorrect, partial, accuracy, brier, directional) of each group."""
    q = F.col("quality")
    right = F.when(OUTCOME(q).isNotNull(), ((F.col("weight") >= 0.5) == (OUTCOME(q) == 1.0)).cast("double"))
    out = claims.groupBy(*by).agg(
        F.count("*").alias("claims"), F.count("quality").alias("resolved"), *[F.count_if(q == x).alias(x) for x in ("correct", "incorrect", "partial")],
        brier(F.col("weight"), q).alias("brier"), F.avg(right).alias("directional"),
    )
    return out.withColumn("accuracy", ratio(F.col("correct"), F.col("correct") + F.col("incorrect")))


def forecast(claims: DataFrame, by: Sequence[str], least: int = 5, step: int = 4) -> DataFrame:
    """(by…, bucket, n, hit_rate): how claims of each bucket of weights came out; null below ``least`` outcomes.

    The last bucket takes a weight of one.
    """
    bucket = F.least(F.floor(F.col("weight") * step), F.lit(step - 1)).cast("int")
    made = claims.where(OUTCOME(F.col("quality")).isNotNull()).groupBy(*by, bucket.alias("bucket")).agg(F.count("*").alias("n"), F.avg(OUTCOME(F.col("quality"))).alias("rate"))
    return made.select(*by, "bucket", "n", F.when(F.col("n") >= least, F.col("rate")).alias("hit_rate"))


def weighted_mean(value: Column, weight: Column) -> Column:
    """The mean of values by weights, null without weight."""
    total = F.sum(weight)
    return F.when(total != 0, F.sum(value * weight) / total)


def panel(df: DataFrame, dimension: str, score: str, mean: float = 7.0, least: float = 5.0) -> DataFrame:
    """(dimension, n, mean, low, high, passed) of a panel's scores: a dimension passes by its mean and its lowest score."""
    out = df.groupBy(dimension).agg(F.count(score).alias("n"), F.avg(score).alias("mean"), F.min(score).alias("low"), F.max(score).alias("high"))
    return out.withColumn("passed", (F.col("n") >= 2) & (F.col("mean") >= mean) & (F.col("low") >= least))


def majority(votes: DataFrame, by: Sequence[str], verdict: str, confidence: str, last: str = "unresolvable") -> DataFrame:
    """(by…, verdict, votes, confidence): the verdict most judges gave; ties go to others before ``last``, then by name.

    confidence is the least of the judges that agree.
    """
    count = votes.groupBy(*by, verdict).agg(F.count("*").alias("votes"), F.min(confidence).alias(confidence))
    best = F.min(F.struct((-F.col("votes")).alias("minus"), (F.col(verdict) == last).alias("late"), F.col(verdict), F.col(confidence))).alias("b")
    return count.groupBy(*by).agg(best).select(*by, f"b.{verdict}", (-F.col("b.minus")).alias("votes"), f"b.{confidence}")


def rubric(parts: Mapping[str, tuple[Column, float]]) -> Column:
    """A weighted score of conditions, in three decimals."""
    total = F.lit(0.0)
    for check, weight in parts.values():
        total = total + F.when(F.coalesce(check, F.lit(False)), F.lit(weight)).otherwise(0.0)
    return F.round(total, 3)


def sampled_share(df: DataFrame, key: str, hit: Column, every: int) -> DataFrame:
    """(n, share, error): the share of hits among the rows whose key's hash falls to one of ``every``, and its standard error."""
    rows = df.where(F.pmod(F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint"), F.lit(every)) == 0)
    out = rows.agg(F.count("*").alias("n"), F.avg(F.coalesce(hit, F.lit(False)).cast("double")).alias("share"))
    return out.withColumn("error", F.when(F.col("n") > 0, F.sqrt(F.col("share") * (1 - F.col("share")) / F.col("n"))))


def fingerprint(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(n, fingerprint): a hash of all rows that their order does not change, added up without gathering them."""
    part = F.conv(F.substring(F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns]), 256), 1, 12), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("n"), F.sum(part).cast("string").alias("fingerprint"))


def latest(df: DataFrame, by: Sequence[str], order: Column, keep: int) -> DataFrame:
    """The last rows of each group."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(order, F.asc("id")))
    return df.withColumn("__n", place).where(F.col("__n") <= keep).drop("__n")
