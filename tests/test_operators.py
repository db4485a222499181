"""Core operators on small fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marlstone.functions import scores, text
from marlstone.operators import components, graph, pages, search, series


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def value(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()["x"]


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 4), (7, 7), (3, 1), (None, 4), (9, 8), (8, 10)], "a int, b int")
    assert dict(map(tuple, components.components(edges).collect())) == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 8: 8, 9: 8, 10: 8}
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)], "a int, b int")
    assert {r[1] for r in components.components(chain).collect()} == {0}
    assert components.components(spark.createDataFrame([], "a int, b int")).count() == 0


@pytest.mark.parametrize("given, want", [("Ärger & Über-Größe!", "arger-uber-gro-e"), ("", ""), ("--", ""), ("A  b", "a-b")])
def test_slugify(spark, given, want):
    assert value(spark, text.slugify(F.lit(given))) == want


def test_text_functions(spark):
    assert value(spark, text.estimated_tokens(F.lit("12345"))) == 2
    assert value(spark, text.word_count(F.lit("one two  three"))) == 3
    assert value(spark, text.word_count(F.lit("预算 审核"))) == 4
    assert value(spark, text.similarity(F.lit("word"), F.lit("word"))) == 1.0
    assert value(spark, text.similarity(F.lit("!"), F.lit("?"))) == 0.0
    assert value(spark, text.plain_text(F.lit("<p>a &amp; b</p><script>x</script>&lt;c&gt;"))) == "a & b <c>"
    assert value(spark, text.wiki_targets(F.lit("[[A|x]] `[[B]]` [[ c ]]"))) == ["a", "c"]
    assert value(spark, text.alias_key(F.lit('  "Big   Co" '))) == "big co"


def test_scores(spark):
    low, high = scores.wilson(F.lit(0), F.lit(0))
    assert (value(spark, low), value(spark, high)) == (0.0, 1.0)
    assert value(spark, scores.cosine(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(0.0)))) == 0.0
    assert value(spark, scores.hyperbolic(F.lit(-5.0), 10.0)) == 1.0


def test_upsert_keeps_and_replaces(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, v string, kept string")
    new = spark.createDataFrame([(2, None, None), (3, "c", "z")], "id int, v string, kept string")
    assert rows(pages.upserted(old, new, ["id"], keep=["kept"])) == [(1, "a", "x"), (2, None, "y"), (3, "c", "z")]


def test_insert_ignore_takes_null_keys_as_equal(spark):
    old = spark.createDataFrame([(1, None)], "id int, s string")
    new = spark.createDataFrame([(1, None), (2, "t"), (2, "t")], "id int, s string")
    assert rows(pages.insert_ignore(old, new, ["id", "s"])) == [(1, None), (2, "t")]


def test_soft_delete_and_purge(spark):
    first = dt.datetime(2024, 1, 1)
    old = spark.createDataFrame([("s", "a", None), ("s", "b", first), ("t", "a", None)], "source_id string, slug string, deleted_at timestamp")
    gone = pages.soft_deleted(old, spark.createDataFrame([("s", "a"), ("s", "b")], "source_id string, slug string"), "2025-01-01")
    assert {(r[0], r[1]): r[2] and r[2].year for r in gone.collect()} == {("s", "a"): 2025, ("s", "b"): 2024, ("t", "a"): None}
    assert pages.purged(gone, "2024-06-01").count() == 2


def test_listing_orders_and_clamps(spark):
    df = spark.createDataFrame([(i, f"n/{i}", "note", dt.datetime(2025, 1, 1 + i), None) for i in range(9)], "id int, slug string, type string, updated_at timestamp, created_at timestamp")
    assert [r["id"] for r in pages.listed(df, ["note"], "2025-01-03", limit=3, offset=1).collect()] == [7, 6, 5]
    assert pages.listed(df, limit=0).count() == 1


def test_graph(spark):
    links = spark.createDataFrame([(1, 2, "a", None), (1, 2, "a", None), (2, 3, "mentions", "m"), (3, 1, "a", "m"), (4, 2, None, None)], "from_page_id int, to_page_id int, link_type string, link_source string")
    nodes = spark.createDataFrame([(i, None, "s") for i in range(1, 6)], "id int, deleted_at timestamp, source_id string")
    assert rows(graph.in_degree(nodes, links)) == [(1, 1), (2, 2), (3, 0), (4, 0), (5, 0)]
    assert rows(graph.orphans(nodes, links)) == [(4,), (5,)]
    assert rows(graph.fan_out(nodes.where("id = 4"), links, 2)) == [(2, 1), (3, 2), (4, 0)]
    assert rows(graph.unreciprocated(links, "a").select("src", "dst")) == [(1, 2), (3, 1)]


def test_fusion_and_quality(spark):
    arm = lambda ids: spark.createDataFrame([(x, i) for i, x in enumerate(ids)], "id int, rank int")
    fused = dict(map(tuple, search.fused([arm([1, 2, 3]), arm([2, 4])], "id").collect()))
    assert max(fused, key=fused.get) == 2 and fused[2] == 1.0
    hits = spark.createDataFrame([("q", 1, 1), ("q", 9, 2), ("q", 2, 3)], "query string, doc int, rank int")
    judged = spark.createDataFrame([("q", 1), ("q", 2), ("r", 5)], "query string, doc int")
    got = {r["query"]: r for r in search.quality(hits, judged, 3).collect()}
    assert got["q"]["recall"] == 1.0 and got["q"]["reciprocal_rank"] == 1.0 and abs(got["q"]["precision"] - 2 / 3) < 1e-9
    assert abs(got["q"]["ndcg"] - 1.5 / (1 + 1 / 1.584962500721156)) < 1e-9 and got["r"]["recall"] == 0.0


def test_budget_and_share(spark):
    df = spark.createDataFrame([(i, 10, "a" if i < 8 else "b", 10.0 - i) for i in range(10)], "id int, cost int, type string, score double")
    assert search.within_budget(df, "cost", 35, [F.asc("id")]).count() == 3
    assert rows(search.capped_share(df, "type", 0.3, 10, "id").groupBy("type").count()) == [("a", 3), ("b", 2)]


def test_series(spark):
    day = dt.date(2025, 1, 1)
    counts = spark.createDataFrame([("x", day + dt.timedelta(i), n) for i, n in enumerate([2, 3, 2, 40, 3]) if i != 1], "k string, day date, n bigint")
    filled = series.gap_filled(counts, ["k"])
    assert filled.count() == 5 and filled.agg(F.sum("n")).first()[0] == 47
    assert [r["n"] for r in series.anomalies(filled, ["k"]).collect()] == [40]
    claims = spark.createDataFrame([("h", 1.0, "correct"), ("h", 0.5, "incorrect"), ("h", 0.2, "partial"), ("h", 0.1, None)], "holder string, weight double, outcome string")
    card = series.scorecard(claims, ["holder"]).first()
    assert (card["claims"], card["resolved"], card["correct"], card["partial"], card["hit_rate"], card["brier"]) == (4, 3, 1, 1, 0.5, 0.125)
    assert {r["bucket"] for r in series.calibration(claims).collect()} == {5, 9}
