"""Ingestion as a stream of files."""

import datetime as dt
import hashlib

from marlstone.streaming import ingest

SCHEMA = "source_id string, source_kind string, received_at timestamp, content_type string, content string, content_hash string"


def event(kind="mail", text="x", at=0, content_type="text/plain", digest=None):
    return ("s", kind, dt.datetime(2025, 1, 1) + dt.timedelta(hours=at), content_type, text, digest or hashlib.sha256(text.encode()).hexdigest())


def stream(spark, tmp_path, batches):
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


def run(spark, df, name):
    q = df.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name).collect()


def test_validation_and_dedup(spark, tmp_path):
    df = stream(spark, tmp_path, [[event(), event(), event("chat"), event(text="bad", digest="zz"), event(content_type="x/y")], [event(at=2), event(text="new", at=3)]])
    assert sorted((r["source_kind"], r["content"]) for r in run(spark, ingest.accepted(df), "kept")) == [("chat", "x"), ("mail", "new"), ("mail", "x")]
    assert sorted(r["reason"] for r in run(spark, ingest.rejected(df), "refused")) == ["content_hash", "content_type"]


def test_upsert_batches_keep_the_newest(spark, tmp_path):
    df = stream(spark, tmp_path, [[event(text="old"), event("chat", "only", 1)], [event(text="new", at=5)]])
    for _ in range(2):  # a second run finds nothing new and loses nothing
        ingest.upsert_batches(df, str(tmp_path / "out"), ["source_kind"], str(tmp_path / "state")).awaitTermination(120)
    assert sorted(r["content"] for r in ingest.current(spark, str(tmp_path / "out"), ["source_kind"]).collect()) == ["new", "only"]


def test_a_repeat_renews_the_sliding_window(spark, tmp_path):
    df = stream(spark, tmp_path, [[event(at=0)], [event(at=20), event(text="y", at=20)], [event(at=40)], [event(at=65)]])
    got = sorted((r["content"], r["received_at"].day, r["received_at"].hour) for r in run(spark, ingest.sliding_dedup(df), "slid"))
    assert got == [("x", 1, 0), ("x", 3, 17), ("y", 1, 20)]


def test_rate_limit_drops_what_is_beyond_it(spark, tmp_path):
    df = stream(spark, tmp_path, [[event(text=f"{i}", at=i / 3600) for i in range(6)], [event(text=f"{i}", at=i / 3600) for i in range(6, 30)]])
    got = sorted(int(r["content"]) for r in run(spark, ingest.rate_limited(df, most=3, seconds=10), "limited"))
    assert got == [0, 1, 2, 10, 11, 12, 20, 21, 22]
