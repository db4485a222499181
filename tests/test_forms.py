"""Benchmarks as sources, normal forms and payloads."""

import json
import re

from pyspark.sql import functions as F

from marlstone.functions import unicode
from marlstone.operators import payloads
from marlstone.sources import benchmarks


def test_qrels_and_baselines(spark, tmp_path):
    (tmp_path / "q.jsonl").write_text(json.dumps({"query_id": "1", "query": "x", "relevant": [{"source_id": "s", "slug": "a"}, {"source_id": "s", "slug": "b"}], "expected_top1": {"source_id": "s", "slug": "b"}}) + "\n# note\n{broken\n")
    assert sorted((r["slug"], r["top"]) for r in benchmarks.qrels(spark, str(tmp_path / "q.jsonl")).collect()) == [("a", False), ("b", True)]
    was = spark.createDataFrame([("q", "t", ["a", "b"], 10.0), ("r", "t", [], 0.0)], benchmarks.BASELINE)
    now = spark.createDataFrame([("q", "t", ["a", "c"], 15.0), ("r", "t", [], 1.0)], benchmarks.BASELINE)
    got = {r["query"]: (round(r["jaccard"], 3), r["same_top"], r["slower"]) for r in benchmarks.replayed(was, now).collect()}
    assert got == {"q": (0.333, True, 1.5), "r": (1.0, True, None)}


def test_chat_benchmark_pages(spark, tmp_path):
    session = {"session_id": "S1", "date": "2024-01-02", "turns": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yes"}]}
    (tmp_path / "c.jsonl").write_text(json.dumps({"question_id": "Q1", "question": "?", "answer": "!", "sessions": [session]}) + "\n")
    row = benchmarks.chat_pages(spark, str(tmp_path / "c.jsonl")).first()
    assert (row["slug"], str(row["date"]), row["compiled_truth"]) == ("chat/q1/s1", "2024-01-02", "**user:** hi\n**assistant:** yes")


def test_normal_forms(spark):
    assert unicode.nfkc_key(" “Ａcme  ﬁrm” ") == "acme firm" and unicode.nfkd_slug("Ünïcode — Ǆ 3½!") == "unicode-dz-31-2" and unicode.nfkd_slug("") == ""
    assert unicode.path_slug("Notes/Ünter 预算//a_b.c/--") == "notes/unter-预算/a_b.c"
    df = spark.createDataFrame([("Åb C",), (None,)], "t string")
    assert [r[0] for r in df.select(unicode.slug(F.col("t"))).collect()] == ["ab-c", None]


def test_groups_keep_every_row(spark):
    df = spark.createDataFrame([(1, i, c) for i, c in enumerate([5, 5, 5, 30, 1, 1])] + [(2, 0, 99)], "g int, o int, c int")
    got = {(r["g"], r["o"]): r["group"] for r in payloads.grouped(df, "g", "c", 10, "o").collect()}
    assert got == {(1, 0): 0, (1, 1): 0, (1, 2): 1, (1, 3): 1, (1, 4): 4, (1, 5): 4, (2, 0): 0}
    out = payloads.summarised(payloads.grouped(df.withColumn("t", F.col("o").cast("string")), "g", "c", 10, "o"), "g", "t").where("g = 1 AND group = 0").first()
    assert (out["rows"], out["summary"]) == (2, "0 … 1")


def test_a_session_is_rewritten_alike(spark):
    text = "See people/ann and people/ann-lee for $10.00 and $20.00 (not $10.005)."
    df = spark.createDataFrame([(1, text), (1, "people/ann paid $10.00"), (2, text), (3, None)], "s int, t string")
    got = [r["t"] for r in payloads.rewritten(df, "s", "t", "key").collect()]
    found = [re.findall(r"people/x-\w+", t) for t in got[:3]]
    assert len(set(found[0])) == 2 and found[1] == [found[0][0]] and found[2] != found[0] and got[3] is None and "ann" not in "".join(got[:3])
    money = [[float(x) for x in re.findall(r"\$(\d+\.\d\d)(?!\d)", t)] for t in got[:2]]
    assert money[0][1] - 2 * money[0][0] <= 0.011 and money[1][0] == money[0][0] and "$10.005" in got[0]
