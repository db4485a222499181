"""Ranking layers and decays."""

import pytest
from pyspark.sql import functions as F

from marlstone.operators import ranking


def test_unlike_only_keeps_the_better_of_two_alike(spark):
    text = "one two three four five six seven eight nine ten"
    df = spark.createDataFrame([("q", 1, 1.0, text), ("q", 2, 0.9, text.upper()), ("q", 3, 0.8, "other words"), ("q", 4, 0.7, None), ("r", 5, 0.1, text)], "q string, id int, score double, t string")
    assert sorted(r["id"] for r in ranking.unlike_only(df, "q", "t").collect()) == [1, 3, 4, 5]
    assert ranking.unlike_only(df.limit(0), "q", "t").count() == 0


def test_clusters_join_the_first_head(spark):
    rows = [(1, 1, [1.0, 0.0], 3), (1, 2, [0.99, 0.1], 2), (1, 3, [0.0, 1.0], 1), (2, 4, [0.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "e int, id int, v array<double>, at int")
    assert {(r["id"], r["head"]) for r in ranking.clusters(df, "e", "v", "at").collect()} == {(1, 1), (2, 1), (3, 3), (4, 4)}


def test_keyset_batches_cover_every_row_once(spark):
    df = spark.createDataFrame([(i % 3, i) for i in range(25)], "a int, b int")
    seen = [tuple(r) for page in ranking.batches(df, 7, ["a", "b"]) for r in page.collect()]
    assert sorted(seen) == sorted((i % 3, i) for i in range(25)) and len(seen) == 25


def test_word_windows_overlap(spark):
    df = spark.createDataFrame([(1, " ".join(map(str, range(620)))), (2, "a b"), (3, " "), (4, None)], "id int, t string")
    got = {(r["id"], r["part"]): r["words"] for r in ranking.word_windows(df, "id", "t").collect()}
    assert set(got) == {(1, 0), (1, 1), (1, 2), (2, 0)}
    assert got[1, 0][-50:] == got[1, 1][:50] and got[1, 2][-1] == "619" and len(got[1, 0]) == 300


@pytest.mark.parametrize("given, want", [("When did it start", "temporal"), ("the review call", "event"), ("who runs it", "entity"), ("glue", "general")])
def test_intent(spark, given, want):
    assert spark.range(1).select(ranking.intent(F.lit(given)).alias("x")).first()["x"] == want


def test_redacted(spark):
    text = "a@b.io Bearer abcdefgh1 123-45-6789 4111 1111 1111 1111"
    assert spark.range(1).select(ranking.redacted(F.lit(text)).alias("x")).first()["x"] == "[email] [token] [ssn] [card]"
