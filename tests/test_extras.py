"""Caches, settings, long jobs and media sources."""

import struct

import pytest
from pyspark.sql import functions as F

from marlstone import modes
from marlstone.operators import cache
from marlstone.sources import media
from marlstone.streaming import jobs

NOW = "2025-01-02 00:00:00"


def test_settings_by_precedence():
    assert modes.resolved() == modes.MODES["balanced"] and modes.resolved("quick").limit == 10
    got = modes.resolved("quick", {"limit": 30, "rrf_k": 10}, {"limit": 5, "rerank": None})
    assert (got.limit, got.rrf_k, got.rerank, got.per_page) == (5, 10, False, 1)
    assert got.fingerprint == modes.resolved("quick", {"rrf_k": 10}, {"limit": 5}).fingerprint != modes.resolved().fingerprint
    for wrong in (("none", None, None), (None, {"wrong": 1}, None), (None, None, {"limit": 0})):
        with pytest.raises(ValueError):
            modes.resolved(*wrong)


@pytest.mark.parametrize(
    "asked, want",
    [
        ("Who founded Acme?", (["Acme"], "founded", "in")), ("where does  Ann Lee work", (["Ann Lee"], "works_at", "out")), ("what connects Ann and Bob?", (["Ann", "Bob"], None, "out")), ("what is new", None),
        ("Who invested in Acme Foods?", (["Acme Foods"], "invested_in", "in")),
    ],
)
def test_relations(asked, want):
    assert modes.relation(asked) == want


def test_cache_holds_while_young_and_unchanged(spark):
    pages = spark.createDataFrame([(1, 5), (2, 7)], "id int, generation bigint")
    results = spark.createDataFrame([("a", 2, 0), ("a", 1, 1), ("b", 1, 0), ("c", 2, 0)], "key string, page_id int, rank int")
    held = cache.snapshot(pages, results).select("key", F.array(F.lit(1.0).cast("float"), F.when(F.col("key") == "a", 0.0).otherwise(0.3).cast("float")).alias("vector"), F.lit("k").alias("knobs"), F.to_timestamp_ntz(F.when(F.col("key") == "c", "2025-01-01 00:00:00").otherwise(NOW)).alias("made_at"), "results", "made_from")
    assert {r["key"]: r["results"] for r in held.collect()} == {"a": [2, 1], "b": [1], "c": [2]}
    changed = pages.withColumn("generation", F.col("generation") + (F.col("id") == 2).cast("int"))
    assert {r["key"] for r in cache.fresh(held, pages, NOW).collect()} == {"a", "b"} and {r["key"] for r in cache.fresh(held, changed, NOW).collect()} == {"b"}
    assert [r["key"] for r in cache.nearest(held, [1.0, 0.01], "k").collect()] == ["a"]
    assert cache.nearest(held, [1.0, 0.0], "other").count() == 0 and cache.nearest(held, [0.0, 1.0], "k").count() == 0
    assert cache.put(held, held.withColumn("made_at", F.to_timestamp_ntz(F.lit("2020-01-01 00:00:00")))).where("made_at < TIMESTAMP_NTZ '2024-01-01'").count() == 0


def test_backfill_goes_on_where_it_stopped(spark, tmp_path):
    df = spark.range(100)
    folder, made = str(tmp_path / "b"), []

    def work(part):
        made.append(1)
        if len(made) == 3:
            raise RuntimeError
        return part.withColumn("x", F.col("id") * 2)

    with pytest.raises(RuntimeError):
        jobs.backfill(df, "id", work, folder, parts=4)
    done = jobs.backfill(df, "id", work, folder, parts=4)
    assert len(made) == 5 and sorted(tuple(r) for r in done.select("id", "x").collect()) == [(i, 2 * i) for i in range(100)]


def test_phases_and_restarts(spark, tmp_path):
    folder, ran = str(tmp_path / "p"), []

    def broken():
        raise RuntimeError

    steps = [("one", lambda: ran.append(1)), ("two", broken), ("three", lambda: ran.append(3))]
    assert jobs.phases(spark, steps, folder) == [("one", "done"), ("two", "failed"), ("three", "waiting")]
    steps[1] = ("two", lambda: ran.append(2))
    assert jobs.phases(spark, steps, folder) == [("one", "skipped"), ("two", "done"), ("three", "done")] and ran == [1, 2, 3]
    with pytest.raises(ValueError):
        jobs.phases(spark, [("a", print), ("a", print)], folder)
    waits, starts = [], []

    class Query:
        def awaitTermination(self):
            starts.append(1)
            if len(starts) < 4:
                raise RuntimeError

    assert jobs.supervised(Query, most=5, first=1, cap=3, sleep=waits.append) == 3 and waits == [1, 2, 3]
    starts.clear()
    with pytest.raises(RuntimeError):
        jobs.supervised(Query, most=1, sleep=waits.append)


def test_rollout_stops_at_a_failed_check(spark):
    df = spark.range(1000)
    assert jobs.rollout(df, "id", lambda d: d, lambda d: d.count() < 500) == (0.1, "failed")
    assert jobs.rollout(df, "id", lambda d: d, lambda d: True, cost=lambda d: d.count(), budget=300) == (0.1, "over budget")
    assert jobs.rollout(df, "id", lambda d: d, lambda d: True) == (1.0, "done")


def test_code_tree_and_unchanged_chunks(spark, tmp_path):
    (tmp_path / "src").mkdir()
    (tmp_path / "node_modules").mkdir()
    (tmp_path / "src" / "a.py").write_text("def f():\n    return g(1)\n\n\ndef h():\n    pass\n")
    (tmp_path / "node_modules" / "b.py").write_text("def no():\n    pass\n")
    (tmp_path / "src" / "c.txt").write_text("def no(): pass")
    tree = media.code_tree(spark, str(tmp_path))
    chunks, edges = media.code_chunks(tree)
    assert sorted((r["symbol_name"], r["start_line"], r["chunk_text"]) for r in chunks.collect()) == [("f", 1, "def f():\n    return g(1)"), ("h", 5, "def h():\n    pass")]
    assert [(r["symbol_name"], r["callee"]) for r in edges.collect()] == [("f", "g")]
    known = chunks.where("symbol_name = 'h'").select("path", "symbol_name", "chunk_text")
    assert {r["symbol_name"]: r["unchanged"] for r in media.code_chunks(tree, known)[0].collect()} == {"f": False, "h": True}


def test_images_and_transcripts(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(b"\x89PNG\r\n\x1a\n" + b"\0" * 8 + struct.pack(">II", 30, 20) + b"\0" * 9)
    (tmp_path / "b.gif").write_bytes(b"GIF89a" + struct.pack("<HH", 7, 8) + b"\0" * 9)
    (tmp_path / "c.jpg").write_bytes(b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08" + struct.pack(">HH", 9, 11) + b"\0" * 20)
    (tmp_path / "d.png").write_bytes(b"no image")
    got = {r["path"]: (r["format"], r["width"], r["height"]) for r in media.image_tree(spark, str(tmp_path)).collect()}
    assert got == {"a.png": ("png", 30, 20), "b.gif": ("gif", 7, 8), "c.jpg": ("jpeg", 11, 9), "d.png": (None, None, None)}
    (tmp_path / "talk.vtt").write_text("x")
    (tmp_path / "draft.txt").write_text("x")
    assert {r["path"] for r in media.transcripts(spark, str(tmp_path), exclude=["^draft"]).collect()} == {"talk.vtt"}
    assert spark.range(1).select(media.sibling_pages(F.lit("Trips/Rome/map.PNG"))).first()[0] == ["trips/rome/map", "trips/rome/index", "trips/rome"]


def test_tailed_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text('{"q": "a"}\n{broken\n\n{"q": "b"}\n')
    q = media.tailed(spark, str(tmp_path / "in"), "q string").writeStream.format("memory").queryName("tail").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(r["q"] for r in spark.table("tail").collect()) == ["a", "b"]
