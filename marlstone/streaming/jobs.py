"""Long jobs: backfills with a durable checkpoint, ordered phases, and restarts of streams.

State lies in tables of a shared folder, one folder a finished step, so a job that stops goes on where
it stopped, and a step that is done again replaces itself.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on any file system that Spark reads."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def _mark(spark: SparkSession, path: str) -> None:
    spark.range(1).select(F.current_timestamp().alias("at")).write.mode("overwrite").parquet(path)


def backfill(df: DataFrame, key: str, work: Callable[[DataFrame], DataFrame], folder: str, parts: int = 16) -> DataFrame:
    """The results of ``work`` over df, made part by part and kept in ``folder``; parts that are there are not made again.

    Parts are cut by the hash of the key, so a part holds the same rows whenever it is made.
    """
    spark = df.sparkSession
    for part in range(parts):
        path = f"{folder}/part={part}"
        if not exists(spark, f"{path}/_SUCCESS"):
            work(df.where(F.pmod(F.xxhash64(key), F.lit(parts)) == part)).write.mode("overwrite").parquet(path)
    return spark.read.parquet(folder).drop("part")


def phases(spark: SparkSession, steps: Sequence[tuple[str, Callable[[], None]]], folder: str, only: Iterable[str] | None = None) -> list[tuple[str, str]]:
    """(step, state) of steps run in order: done, skipped (done before, or not asked for), failed, or waiting behind a failed one."""
    names = [n for n, _ in steps]
    if len(set(names)) != len(names):
        raise ValueError("two steps have one name")
    out, failed = [], False
    for name, step in steps:
        if failed:
            out.append((name, "waiting"))
        elif (only is not None and name not in set(only)) or exists(spark, f"{folder}/{name}/_SUCCESS"):
            out.append((name, "skipped"))
        else:
            try:
                step()
                _mark(spark, f"{folder}/{name}")
                out.append((name, "done"))
            except Exception:  # a failed step stops those behind it; the next run begins with it
                failed = True
                out.append((name, "failed"))
    return out


def supervised(start: Callable[[], object], most: int = 10, first: float = 1.0, cap: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> int:
    """Start a stream and wait for its end; start it again after failures, each time later, ``most`` times at most.

    Returns the number of restarts; the last failure is raised when none is left.
    """
    for attempt in range(most + 1):
        try:
            start().awaitTermination()
            return attempt
        except Exception:
            if attempt == most:
                raise
            sleep(min(cap, first * 2**attempt))
    return most


def rollout(df: DataFrame, key: str, work: Callable[[DataFrame], DataFrame], verify: Callable[[DataFrame], bool], shares: Sequence[float] = (0.01, 0.1, 1.0), cost: Callable[[DataFrame], float] | None = None, budget: float | None = None) -> tuple[float, str]:
    """(share reached, state) of work done on growing shares of the keys, as long as a check holds and the cost stays in a budget.

    Shares are cut by the hash of the key, so a larger one holds the smaller ones.
    """
    reached, spent = 0.0, 0.0
    for share in shares:
        part = df.where(F.pmod(F.xxhash64(key), F.lit(10_000)) < int(share * 10_000))
        if cost is not None and budget is not None:
            spent += cost(part)
            if spent > budget:
                return reached, "over budget"
        if not verify(work(part)):
            return reached, "failed"
        reached = share
    return reached, "done"
