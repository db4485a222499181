"""Code trees, images, transcripts and tailed lines as sources."""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import strings
from ..operators import chunkers
from .files import SKIPPED, _relative

#: Image files are read up to this size.
MOST_BYTES = 20_000_000


def _inside(path: Column) -> Column:
    out = F.lit(True)
    for folder in SKIPPED:
        out = out & ~F.concat(F.lit("/"), path).contains(f"/{folder}/")
    return out


def code_tree(spark: SparkSession, root: str, most_bytes: int = 2_000_000) -> DataFrame:
    """(path, language, code): the code files of a folder, by their endings; larger files are left out."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    path = _relative(root)
    rows = rows.where(F.col("length") <= most_bytes).select(path.alias("path"), F.decode("content", "UTF-8").alias("code"))
    return rows.where(_inside(F.col("path"))).withColumn("language", strings.language_of(F.col("path"))).where("language IS NOT NULL").select("path", "language", "code")


def code_chunks(tree: DataFrame, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(chunks, edges) of a code tree: one chunk a top-level symbol, and its calls.

    chunks: (path, symbol_name, symbol_type, start_line, end_line, chunk_text, unchanged), where
    unchanged tells that ``known`` (path, symbol_name, chunk_text) holds the same text. edges: (path,
    symbol_name, callee).
    """
    found = chunkers.symbol_rows(tree, "path", "code", "language")
    lines = tree.select("path", F.split("code", "\n").alias("l"))
    rows = found.join(lines, "path").select("path", F.col("name").alias("symbol_name"), F.col("kind").alias("symbol_type"), F.col("first_line").alias("start_line"), F.col("last_line").alias("end_line"), F.array_join(F.slice("l", F.col("first_line"), F.col("last_line") - F.col("first_line") + 1), "\n").alias("chunk_text"))
    if known is None:
        chunks = rows.withColumn("unchanged", F.lit(False))
    else:
        old = known.select("path", "symbol_name", F.col("chunk_text").alias("__old"))
        chunks = rows.join(old, ["path", "symbol_name"], "left").withColumn("unchanged", F.coalesce(F.col("chunk_text") == F.col("__old"), F.lit(False))).drop("__old")
    return chunks, found.select("path", F.col("name").alias("symbol_name"), F.explode("calls").alias("callee"))


def image_shape(data: bytes) -> tuple[str, int, int] | None:
    """(format, width, height) by the head of an image file; None for what is no PNG, GIF or JPEG."""
    if data[:8] == b"\x89PNG\r\n\x1a\n" and len(data) >= 24:
        return "png", *struct.unpack(">II", data[16:24])
    if data[:6] in (b"GIF87a", b"GIF89a") and len(data) >= 10:
        return "gif", *struct.unpack("<HH", data[6:10])
    if data[:2] == b"\xff\xd8":
        at = 2
        while at + 9 < len(data) and data[at] == 0xFF:
            marker, size = data[at + 1], struct.unpack(">H", data[at + 2 : at + 4])[0]
            if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                height, width = struct.unpack(">HH", data[at + 5 : at + 9])
                return "jpeg", width, height
            at += 2 + size
    return None


def image_tree(spark: SparkSession, root: str, most_bytes: int = MOST_BYTES) -> DataFrame:
    """(path, bytes, format, width, height): the images of a folder; format is null where the content is none."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{png,jpg,jpeg,gif,PNG,JPG,JPEG,GIF}").load(root)
    rows = files.where(F.col("length") <= most_bytes).select(_relative(root).alias("path"), F.col("length").alias("bytes"), "content")

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            shapes = [image_shape(bytes(c)) or (None, None, None) for c in frame["content"]]
            yield pd.DataFrame({"path": frame["path"], "bytes": frame["bytes"], "format": [s[0] for s in shapes], "width": pd.array([s[1] for s in shapes], "Int32"), "height": pd.array([s[2] for s in shapes], "Int32")})

    return rows.mapInPandas(read, "path string, bytes bigint, format string, width int, height int")


def sibling_pages(path: Column) -> Column:
    """The slugs under which the page of an image may stand: its own name, its folder's index, its folder."""
    bare = F.regexp_replace(F.lower(path), r"\.[a-z0-9]+$", "")
    folder = F.regexp_extract(bare, r"^(.*)/[^/]*$", 1)
    return F.array_distinct(F.filter(F.array(bare, F.when(folder != "", F.concat(folder, F.lit("/index"))), F.when(folder != "", folder)), lambda x: x.isNotNull()))


def transcripts(spark: SparkSession, root: str, include: Sequence[str] = (r"\.(txt|md|vtt|srt)$",), exclude: Sequence[str] = ()) -> DataFrame:
    """(path, bytes, modified): transcript files by patterns over their paths; no content is read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select(_relative(root).alias("path"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
    wanted, refused = F.lit(False), F.lit(False)
    for pattern in include:
        wanted = wanted | F.col("path").rlike(pattern)
    for pattern in exclude:
        refused = refused | F.col("path").rlike(pattern)
    return rows.where(wanted & ~refused)


def tailed(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """A stream of the JSON lines of a folder's files, as files come; broken lines are left out."""
    lines = spark.readStream.text(root).where("trim(value) <> ''")
    parsed = lines.select(F.from_json("value", f"{schema}, _broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}).alias("r"))
    return parsed.where("r IS NOT NULL AND r._broken IS NULL").select("r.*").drop("_broken")
