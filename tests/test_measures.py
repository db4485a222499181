"""Aggregates on made tables: ties, empty groups and missing outcomes."""

from pyspark.sql import functions as F

from marlstone.operators import measures

SCHEMA = "holder string, weight double, quality string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_scorecard_counts_binary_outcomes_alone(spark):
    df = spark.createDataFrame([("a", 0.8, "correct"), ("a", 0.3, "incorrect"), ("a", 0.9, "partial"), ("a", 0.5, None), ("b", 0.5, None)], SCHEMA)
    got = {r["holder"]: (r["claims"], r["resolved"], r["correct"], round(r["brier"], 4) if r["brier"] is not None else None, r["directional"], r["accuracy"]) for r in measures.scorecard(df, ["holder"]).collect()}
    assert got == {"a": (4, 3, 1, round((0.04 + 0.09) / 2, 4), 1.0, 0.5), "b": (1, 0, 0, None, None, None)}
    assert measures.scorecard(df.limit(0), ["holder"]).count() == 0


def test_forecast_needs_outcomes_and_takes_a_weight_of_one(spark):
    df = spark.createDataFrame([("a", 1.0, "correct")] * 4 + [("a", 0.8, "incorrect"), ("a", 0.1, "correct")], SCHEMA)
    assert rows(measures.forecast(df, ["holder"])) == [("a", 0, 1, None), ("a", 3, 5, 0.8)]


def test_majority_breaks_ties(spark):
    votes = spark.createDataFrame([(1, "yes", 0.9), (1, "unresolvable", 0.1), (2, "no", 0.4), (2, "no", 0.2), (2, "yes", 0.9), (3, "b", 0.5), (3, "a", 0.6)], "q int, verdict string, confidence double")
    assert rows(measures.majority(votes, ["q"], "verdict", "confidence")) == [(1, "yes", 1, 0.9), (2, "no", 2, 0.2), (3, "a", 1, 0.6)]


def test_panel_mean_and_fingerprint(spark):
    df = spark.createDataFrame([("x", 7.0), ("x", 8.0), ("y", 9.0), ("z", 10.0), ("z", 4.0)], "d string, s double")
    assert {r["d"]: r["passed"] for r in measures.panel(df, "d", "s").collect()} == {"x": True, "y": False, "z": False}
    assert df.agg(measures.weighted_mean(F.col("s"), F.lit(0.0)).alias("m")).first()["m"] is None
    one, two = (measures.fingerprint(d, ["d", "s"]).first() for d in (df, df.orderBy(F.desc("s"))))
    assert one == two and one != measures.fingerprint(df.where("s > 4"), ["d", "s"]).first() and measures.fingerprint(df.limit(0), ["d"]).first()["n"] == 0
