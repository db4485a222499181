"""Writes on made tables: repeats, ties, empty tables and keys that hold nulls."""

import datetime as dt

from pyspark.sql import functions as F

from marlstone.operators import writes

DAY = dt.datetime(2025, 1, 1)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_deleted_compares_nulls_and_takes_empty_tables(spark):
    df = spark.createDataFrame([(1, None), (1, "a"), (2, None)], "k int, s string")
    assert rows(writes.deleted(df, df.where("k = 1 AND s IS NULL"), ["k", "s"])) == [(1, "a"), (2, None)]
    assert rows(writes.deleted(df, df.limit(0), ["k", "s"])) == rows(df) and writes.deleted(df.limit(0), df, ["k", "s"]).count() == 0


def test_updated_from_takes_one_row_a_key(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, None, 3)], "id int, s string, n int")
    new = spark.createDataFrame([(1, "x"), (1, "y"), (2, None), (9, "z")], "id int, s string")
    assert rows(writes.updated_from(df, new, ["id"])) == [(1, "y", 1), (2, None, 2), (3, None, 3)]
    assert rows(writes.updated_from(df, new, ["id"], overwrite=False)) == [(1, "y", 1), (2, "b", 2), (3, None, 3)]
    assert rows(writes.updated_from(df, new, ["id"], where=F.col("n") > 1)) == [(1, "a", 1), (2, None, 2), (3, None, 3)]


def test_put_chunks_keeps_vectors_of_kept_texts(spark):
    schema = "page_id int, chunk_index int, chunk_text string, embedding array<float>, embedded_at timestamp"
    late = DAY + dt.timedelta(days=1)
    old = spark.createDataFrame([(1, 0, "a", [1.0], DAY), (1, 1, "b", [2.0], DAY), (1, 2, "c", [3.0], DAY), (2, 0, "z", [9.0], DAY)], schema)
    made = spark.createDataFrame([(1, 0, "a", None, None), (1, 1, "B", None, late)], schema)
    got = rows(writes.put_chunks(old, made, spark.createDataFrame([(1,)], "page_id int")))
    assert got == [(1, 0, "a", [1.0], DAY), (1, 1, "B", None, late), (2, 0, "z", [9.0], DAY)]


def test_superseded_numbers_new_rows_and_refuses_resolved_ones(spark):
    claims = spark.createDataFrame([(1, 1, "a", 0.5, True, None), (1, 2, "b", 0.5, True, "correct"), (1, 3, "c", 0.5, True, None)], "page_id int, row_num int, claim string, weight double, active boolean, quality string")
    new = spark.createDataFrame([(1, 1, "A", 0.9), (1, 2, "B", 0.9), (1, 3, "C", 0.9), (1, 8, "no", 0.9)], "page_id int, old_row int, claim string, weight double")
    got = {r["row_num"]: (r["claim"], r["active"], r["superseded_by"]) for r in writes.superseded(claims, new).collect()}
    assert got == {1: ("a", False, 4), 2: ("b", True, None), 3: ("c", False, 5), 4: ("A", True, None), 5: ("C", True, None)}


def test_merged_json_drops_replaces_and_adds(spark):
    df = spark.createDataFrame([('{"a": "1", "b": "2"}',), (None,)], "c string")
    assert rows(df.select(writes.merged_json(F.col("c"), {"a": None, "b": "3", "d": "4"}))) == [('{"b":"3","d":"4"}',), ('{"b":"3","d":"4"}',)]


def test_numbered_goes_on_from_the_greatest(spark):
    df = spark.createDataFrame([(5, "a")], "id bigint, s string")
    got = writes.numbered(df, spark.createDataFrame([(0, c) for c in "dbca"], "id bigint, s string"), "id", ["s"])
    assert rows(got) == [(5, "a"), (6, "a"), (7, "b"), (8, "c"), (9, "d")]


def test_generation_goes_up_with_content(spark):
    before = spark.createDataFrame([(1, "a", 3), (2, "b", 1)], "id int, s string, generation bigint")
    after = spark.createDataFrame([(1, "A", 0), (2, "b", 0), (3, "c", 0)], "id int, s string, generation bigint")
    assert {r["id"]: r["generation"] for r in writes.generation_bumped(before, after, "id", ["s"]).collect()} == {1: 4, 2: 1, 3: 1}


def test_put_links_resolves_both_ends(spark):
    pages = spark.createDataFrame([(1, "a", "s"), (2, "b", "s"), (3, "a", "t")], "id int, slug string, source_id string")
    links = spark.createDataFrame([(1, 2, "x", None, None)], "src int, dst int, link_type string, link_source string, origin int")
    new = spark.createDataFrame([("a", "b", None, "s", "x", None), ("a", "b", "b", "s", "y", "m"), ("a", "nowhere", None, "s", "x", None)], "from_slug string, to_slug string, origin_slug string, source_id string, link_type string, link_source string")
    assert rows(writes.put_links(links, new, pages)) == [(1, 2, "x", None, None), (1, 2, "y", "m", 2)]
