"""Chat logs of fifteen shapes: the shape is chosen by scores, and lines become turns.

Every line is tested against every shape in one pass; a document's shape is the one that most of its
first lines match, or, where few do, most of all its lines (ties go to the shape named first). A line
of that shape begins a turn, others go on with it. Everything runs in the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .documents import lines


@dataclass(frozen=True)
class Shape:
    """A line that begins a turn, and which groups hold speaker, hour, minute, half of the day and text (0 for none)."""

    name: str
    pattern: str
    speaker: int
    hour: int = 0
    minute: int = 0
    half: int = 0
    text: int = 0


_NAME = r"[\p{L}\p{N}][\p{L}\p{N} .'-]*?"
# The shapes of chat lines, in the order in which ties are broken.
SHAPES = (
    Shape("bold-dated", r"^\*\*(.+?)\*\*\s*\(\d{4}-\d{2}-\d{2}\s+(\d{1,2}):(\d{2})\s*(AM|PM|am|pm)?\)\s*:\s*(.*)$", 1, 2, 3, 4, 5),
    Shape("bold-bracket", r"^\*\*\[(\d{1,2}):(\d{2})\]\s+(.+?):\*\*\s*(.*)$", 3, 1, 2, 0, 4),
    Shape("bold-time", r"^\*\*(.+?)\*\*\s+\((\d{1,2}):(\d{2})(?::\d{2})?\)\s*:\s*(.*)$", 1, 2, 3, 0, 4),
    Shape("speaker-letter", r"^(Speaker [A-Z0-9]+):\s*(.*)$", 1, text=2),
    Shape("bold-name", r"^\*\*([^\[*][^*]*?):\*\*\s*(.*)$", 1, text=2),
    Shape("name-dated", rf"^({_NAME}),\s*\[[A-Za-z]{{3}}\s+\d{{1,2}},\s*\d{{4}}\s+at\s+(\d{{1,2}}):(\d{{2}}):\d{{2}}\s*(AM|PM)\]\s*$", 1, 2, 3, 4),
    Shape("bracket-dated", r"^\[\d{1,2}/\d{1,2}/\d{2,4},\s*(\d{1,2}):(\d{2}):\d{2}\]\s+(.+?):\s+(.*)$", 3, 1, 2, 0, 4),
    Shape("dash-dated", r"^\d{1,2}/\d{1,2}/\d{2,4},\s+(\d{1,2}):(\d{2})\s*(AM|PM)\s+-\s+(.+?):\s+(.*)$", 4, 1, 2, 3, 5),
    Shape("bracket-alone", r"^\[\d{1,2}/\d{1,2}/\d{4}\s+(\d{1,2}):(\d{2})\s*(AM|PM)\]\s+(.+)$", 4, 1, 2, 3),
    Shape("name-comma", rf"^({_NAME}),\s+\d{{1,2}}/\d{{1,2}}/\d{{4}}\s+(\d{{1,2}}):(\d{{2}})\s*(AM|PM):\s+(.*)$", 1, 2, 3, 4, 5),
    Shape("name-utc", r"^(.+?)\s+\(\d{4}-\d{2}-\d{2}\s+(\d{1,2}):(\d{2}):\d{2}\s+UTC\):\s+(.*)$", 1, 2, 3, 0, 4),
    Shape("name-today", rf"^({_NAME})\s+—\s+(?:Today|Yesterday)\s+at\s+(\d{{1,2}}):(\d{{2}})\s*(AM|PM)?\s*$", 1, 2, 3, 4),
    Shape("bracket-address", r"^\[(\d{1,2}):(\d{2})\]\s+(@[\p{L}\p{N}_.-]+:[\p{L}\p{N}.-]+):\s+(.*)$", 3, 1, 2, 0, 4),
    Shape("angle", r"^<([^>]+)>\s+(.*)$", 1, text=2),
    Shape("time-angle", r"^(\d{1,2}):(\d{2})\s+<([^>]+)>\s+(.*)$", 3, 1, 2, 0, 4),
    Shape("bracket-time", r"^\[(\d{1,2}):(\d{2})(?::\d{2})?\]\s+([^:]{1,60}):\s+(.*)$", 3, 1, 2, 0, 4),
)
#: Lines at the head that are scored, the share of them below which all lines are, and the least share that counts.
HEAD, FEW, LEAST = 10, 0.3, 0.05


def scores(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, shape, score): the shape of each document and the share of lines that have it; null where none has enough."""
    rows = lines(df, key, text).where(F.col("line").rlike(r"\S"))
    n = F.row_number().over(Window.partitionBy(key).orderBy("line_no"))
    marks = F.array(*[F.col("line").rlike(s.pattern).cast("int") for s in SHAPES])
    flat = rows.select(key, (n <= HEAD).cast("int").alias("head"), marks.alias("m"))
    hits = [F.sum(F.col("m")[i] * F.col("head")).alias(f"h{i}") for i in range(len(SHAPES))] + [F.sum(F.col("m")[i]).alias(f"a{i}") for i in range(len(SHAPES))]
    told = flat.groupBy(key).agg(F.sum("head").alias("heads"), F.count("*").alias("all"), *hits)
    best = lambda of, by: F.array_max(F.array(*[F.struct((F.col(f"{of}{i}") / F.col(by)).alias("score"), F.lit(-i).alias("first")) for i in range(len(SHAPES))]))
    chosen = told.withColumn("h", best("h", "heads")).withColumn("a", best("a", "all")).withColumn("b", F.when(F.col("h.score") >= FEW, F.col("h")).otherwise(F.col("a")))
    return chosen.select(key, F.when(F.col("b.score") >= LEAST, -F.col("b.first")).alias("shape"), F.col("b.score").alias("score"))


def _group(line: Column, shape: Column, which: str) -> Column:
    out = F.lit(None).cast("string")
    for i, s in enumerate(SHAPES):
        number = getattr(s, which)
        if number:
            out = F.when(shape == i, F.regexp_extract(line, s.pattern, number)).otherwise(out)
    return out


def turns(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, shape, turn from 1, hour, minute, speaker, said) of each document that has a shape.

    Hours of twelve are made hours of twenty-four; speakers lose marks before their first letter; lines
    before the first turn belong to none.
    """
    shaped = scores(df, key, text).where("shape IS NOT NULL").select(key, "shape")
    rows = lines(df, key, text).join(shaped, key)
    begins = F.lit(False)
    for i, s in enumerate(SHAPES):
        begins = F.when(F.col("shape") == i, F.col("line").rlike(s.pattern)).otherwise(begins)
    running = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    marked = rows.withColumn("begins", begins).withColumn("turn", F.sum(F.col("begins").cast("int")).over(running)).where("turn > 0")
    said = F.when(F.col("begins"), F.coalesce(_group(F.col("line"), F.col("shape"), "text"), F.lit(""))).otherwise(F.col("line"))
    grouped = marked.groupBy(key, "shape", "turn").agg(F.min_by("line", "line_no").alias("line"), F.array_sort(F.collect_list(F.struct("line_no", said.alias("p")))).alias("parts"))
    part = lambda which: _group(F.col("line"), F.col("shape"), which)
    hour, half = F.nullif(part("hour"), F.lit("")).cast("int"), F.upper(part("half"))
    hour = F.when(half == "PM", hour % 12 + 12).when(half == "AM", hour % 12).otherwise(hour)
    name = F.trim(F.regexp_replace(part("speaker"), r"^[^\p{L}\p{N}]+", ""))
    names = F.element_at(F.array(*[F.lit(s.name) for s in SHAPES]), F.col("shape") + 1)
    body = F.regexp_replace(F.array_join(F.transform("parts", lambda p: p["p"]), "\n"), r"^\s+|\s+$", "")
    return grouped.select(key, names.alias("shape"), "turn", hour.alias("hour"), F.nullif(part("minute"), F.lit("")).cast("int").alias("minute"), F.when(name != "", name).otherwise(part("speaker")).alias("speaker"), body.alias("said"))
