"""Push ingestion on Structured Streaming: validate, deduplicate, count."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The content types an ingestion event may have.
CONTENT_TYPES = (
    "text/markdown", "text/plain", "text/html", "application/json", "application/pdf", "audio/wav", "audio/mpeg", "image/png", "image/jpeg",
)


def rejection() -> Column:
    """Why an ingestion event is not valid; null for a valid one."""
    return (
        F.when(F.coalesce(F.trim("source_id"), F.lit("")) == "", "source_id")
        .when(F.coalesce(F.trim("source_kind"), F.lit("")) == "", "source_kind")
        .when(F.col("received_at").isNull(), "received_at")
        .when(~F.coalesce(F.col("content_type").isin(*CONTENT_TYPES), F.lit(False)), "content_type")
        .when(F.col("content").isNull(), "content")
        .when(~F.coalesce(F.col("content_hash").rlike("^[0-9a-f]{64}$"), F.lit(False)), "content_hash")
    )


def accepted(events: DataFrame, delay: str = "24 hours") -> DataFrame:
    """Valid events, each (source_kind, content_hash) once within the delay; state is dropped behind the watermark."""
    valid = events.where(rejection().isNull())
    return valid.withWatermark("received_at", delay).dropDuplicatesWithinWatermark(["source_kind", "content_hash"])


def rejected(events: DataFrame) -> DataFrame:
    """Events that fail validation, with the reason, for a quarantine sink."""
    return events.withColumn("reason", rejection()).where("reason IS NOT NULL")


def tumbling_counts(events: DataFrame, by: str, width: str = "1 day", delay: str = "1 day", at: str = "received_at") -> DataFrame:
    """Counts of tumbling windows; late rows count until the watermark passes their window."""
    return events.withWatermark(at, delay).groupBy(F.window(at, width), by).agg(F.count("*").alias("n")).select(
        F.col("window.start").alias("start"), by, "n"
    )


def sliding_dedup(events: DataFrame, hours: int = 24) -> DataFrame:
    """Valid events without those that repeat a (source_kind, content_hash) met less than ``hours`` before.

    The window slides: a repeat renews it, also when it is not given on. State lapses behind the watermark.
    """
    valid = events.where(rejection().isNull()).withWatermark("received_at", f"{hours} hours")
    names, width = valid.columns, pd.Timedelta(hours=hours)

    def keep(key, frames, state):
        last = pd.Timestamp(state.get[0], unit="us") if state.exists else None
        if state.hasTimedOut:
            state.remove()
            return
        kept = []
        rows = pd.concat(list(frames)).sort_values("received_at", kind="stable")
        for place, at in zip(range(len(rows)), rows["received_at"]):
            if last is None or at - last >= width:
                kept.append(place)
            last = at if last is None else max(last, at)
        state.update((int(last.value // 1000),))
        state.setTimeoutTimestamp(max(int((last + width).value // 1_000_000), state.getCurrentWatermarkMs() + 1))
        yield rows.iloc[kept][names]

    return valid.groupBy("source_kind", "content_hash").applyInPandasWithState(keep, valid.schema, "last bigint", "append", "EventTimeTimeout")


def rate_limited(events: DataFrame, most: int = 100, seconds: int = 10, by: str = "source_id") -> DataFrame:
    """Events without those beyond ``most`` of one source within ``seconds``; dropped ones do not count."""
    timed = events.withWatermark("received_at", f"{seconds} seconds")
    names, width = timed.columns, seconds * 1_000_000

    def pass_on(key, frames, state):
        if state.hasTimedOut:
            state.remove()
            return
        recent = list(state.get[0]) if state.exists else []
        rows = pd.concat(list(frames)).sort_values("received_at", kind="stable")
        kept = []
        for place, at in enumerate(rows["received_at"]):
            now = int(at.value // 1000)
            recent = [t for t in recent if now - t < width]
            if len(recent) < most:
                recent.append(now)
                kept.append(place)
        state.update((recent,))
        state.setTimeoutTimestamp(max((max(recent, default=0) + width) // 1000, state.getCurrentWatermarkMs() + 1))
        yield rows.iloc[kept][names]

    return timed.groupBy(by).applyInPandasWithState(pass_on, timed.schema, "recent array<bigint>", "append", "EventTimeTimeout")


def _newest(rows: DataFrame, key: Sequence[str], at: str) -> DataFrame:
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rows.columns), at).alias("r")).select("r.*")


def upsert_batches(stream: DataFrame, path: str, key: Sequence[str], checkpoint: str, at: str = "received_at"):
    """Start a query that writes the newest row of each key of every batch under ``path``; ``current`` merges them.

    A batch is one folder named by its number, so a repeated batch replaces itself, an empty one writes
    nothing, and no batch reads or rewrites those before it.
    """

    def merge(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            _newest(batch, key, at).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, path: str, key: Sequence[str], at: str = "received_at") -> DataFrame:
    """The newest row of each key of all batches; of equal times the later batch holds."""
    rows = spark.read.parquet(path)
    kept = [c for c in rows.columns if c != "batch"]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*kept), F.struct(at, "batch")).alias("r")).select("r.*")
