"""Session factory and lineage-cutting helper shared by all operators."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_written: list[str] = []
_shipped: set[str] = set()


def session(app: str = "marlstone", cores: str | int = "*", **conf: str) -> SparkSession:
    """A local session with the settings the tests and the bench use; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once an application, wherever they run."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    folder = Path(tempfile.mkdtemp(prefix="marlstone-ship-"))  # the driver serves the file from here to the end
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    shutil.copytree(package, folder / "staged" / package.name, ignore=shutil.ignore_patterns("__pycache__"))
    context.addPyFile(shutil.make_archive(str(folder / package.name), "zip", folder / "staged"))
    _shipped.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder that outlives executors: spark.checkpoint.dir, or (only where that is unset and all runs in one process, as in tests) a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("a cluster needs a shared folder: set spark.checkpoint.dir")
        found = "file://" + tempfile.mkdtemp(prefix="marlstone-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def materialize(df: DataFrame) -> DataFrame:
    """Write df once as a table in the shared folder and read it back.

    It cuts the lineage of iterative plans and survives the loss of executors. Unlike
    ``checkpoint()`` it evaluates df once and stores columns compressed.
    """
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"marlstone-{uuid.uuid4().hex}")
    df.write.parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_materialized(spark: SparkSession) -> int:
    """Delete every table that materialize() wrote; returns their number."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    count = 0
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(conf).delete(path, True)
        count += 1
    return count


def _at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None:
        try:
            drop_materialized(spark)
        except Exception:  # the JVM may already be gone
            pass


atexit.register(_at_exit)
