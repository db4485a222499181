"""Chunkers: by words along delimiters, by code symbols, and by character budgets.

Defined results: null and blank texts have no chunks; texts are processed whole; chunks of a text do
not depend on other rows.
"""

from __future__ import annotations

import ast
import hashlib
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Delimiters from coarse to fine: paragraphs, lines, sentences, clauses, words.
LEVELS = (r"\n\s*\n", r"\n", r"(?<=[.!?。！？])\s+", r"(?<=[,;:，；：])\s+", r"\s+")
#: Words of a chunk, of its overlap, and characters of a piece that has no blanks.
TARGET, OVERLAP, HARD, HARD_OVERLAP = 300, 50, 6000, 500


def words(text: str) -> int:
    return len(text.split())


def pieces(text: str, target: int = TARGET, level: int = 0) -> list[str]:
    """The text cut at the coarsest delimiters that bring every piece to ``target`` words."""
    if words(text) <= target and len(text) <= HARD:
        return [text] if text.strip() else []
    if level == len(LEVELS):
        return [text[i : i + HARD] for i in range(0, max(1, len(text) - HARD_OVERLAP), HARD - HARD_OVERLAP)]
    return [piece for part in re.split(LEVELS[level], text) if part.strip() for piece in pieces(part, target, level + 1)]


def merged(found: list[str], target: int = TARGET) -> list[str]:
    """Neighbouring pieces put together up to one and a half times the target."""
    out: list[str] = []
    for piece in found:
        if out and words(out[-1]) < target and words(out[-1]) + words(piece) <= math.ceil(1.5 * target) and len(out[-1]) + len(piece) < HARD:
            out[-1] = f"{out[-1]}\n{piece}"
        else:
            out.append(piece)
    return out


def recursive(text: str | None, target: int = TARGET, overlap: int = OVERLAP) -> list[tuple[str, int]]:
    """(chunk, words of the chunk before that it begins with); a chunk before of no more words than the overlap gives none."""
    out: list[tuple[str, int]] = []
    before: list[str] = []
    for chunk in merged(pieces(text or "", target), target):
        lead = before[-overlap:] if len(before) > overlap else []
        out.append((" ".join([*lead, chunk]), len(lead)))
        before = chunk.split()
    return out


def chunked(df: DataFrame, key: str, text: str, target: int = TARGET, overlap: int = OVERLAP) -> DataFrame:
    """(key, chunk_index, chunk_text, lead): recursive chunks of each text."""
    kind = df.schema[key].dataType.simpleString()

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [(k, i, chunk, lead) for k, t in zip(frame["k"], frame["t"]) for i, (chunk, lead) in enumerate(recursive(t, target, overlap))]
            yield pd.DataFrame(out, columns=["k", "chunk_index", "chunk_text", "lead"])

    rows = df.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")).where("t IS NOT NULL")
    return rows.mapInPandas(cut, f"k {kind}, chunk_index int, chunk_text string, lead int").withColumnRenamed("k", key)


# What begins a symbol in languages that are read by lines: kind, pattern with the name.
SYMBOLS = {
    "go": (("function", r"^func\s+(?:\([^)]*\)\s*)?(\w+)\s*\("), ("type", r"^type\s+(\w+)\s")),
    "typescript": (("function", r"^(?:export\s+)?(?:async\s+)?function\s+(\w+)"), ("class", r"^(?:export\s+)?(?:abstract\s+)?class\s+(\w+)"), ("interface", r"^(?:export\s+)?interface\s+(\w+)")),
    "python": (("function", r"^(?:async\s+)?def\s+(\w+)"), ("class", r"^class\s+(\w+)")),
}
SYMBOLS["javascript"] = SYMBOLS["typescript"]


def symbols(code: str | None, language: str | None) -> list[tuple[str, str, int, int, list[str]]]:
    """(name, kind, first line, last line, called names) of the top-level symbols of a piece of code.

    Python is read as a syntax tree; what does not parse, and other languages, by the lines that begin
    a symbol, each lasting until the next.
    """
    code = code or ""
    lines = code.split("\n")
    if language == "python":
        try:
            out = []
            for node in ast.parse(code).body:
                if isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)):
                    called = sorted({n.func.id if isinstance(n.func, ast.Name) else n.func.attr for n in ast.walk(node) if isinstance(n, ast.Call) and isinstance(n.func, (ast.Name, ast.Attribute))})
                    out.append((node.name, "class" if isinstance(node, ast.ClassDef) else "function", node.lineno, node.end_lineno, called))
            return out
        except (SyntaxError, ValueError):
            pass
    begins = []
    for i, line in enumerate(lines, 1):
        for kind, pattern in SYMBOLS.get(language or "", ()):
            if found := re.match(pattern, line):
                begins.append((found[1], kind, i))
                break
    out = []
    for n, (name, kind, first) in enumerate(begins):
        last = begins[n + 1][2] - 1 if n + 1 < len(begins) else len(lines)
        body = "\n".join(lines[first : last])
        out.append((name, kind, first, last, sorted(set(re.findall(r"\b([A-Za-z_]\w*)\(", body)))))
    return out


def symbol_rows(df: DataFrame, key: str, code: str, language: str) -> DataFrame:
    """(key, name, kind, first_line, last_line, calls): the top-level symbols of each row's code."""
    kind = df.schema[key].dataType.simpleString()

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [(k, *s) for k, c, lang in zip(frame["k"], frame["c"], frame["l"]) for s in symbols(c, lang)]
            yield pd.DataFrame(out, columns=["k", "name", "kind", "first_line", "last_line", "calls"])

    rows = df.select(F.col(key).alias("k"), F.col(code).alias("c"), F.col(language).alias("l")).where("c IS NOT NULL")
    return rows.mapInPandas(read, f"k {kind}, name string, kind string, first_line int, last_line int, calls array<string>").withColumnRenamed("k", key)


def budgeted(text: str | None, budget: int) -> list[str]:
    """Pieces of at most ``budget`` characters, cut at the last blank line, line end or blank of a search that begins where the content's hash tells.

    Equal texts are cut alike; texts that differ are not all cut at the same places.
    """
    out, text = [], text or ""
    while len(text) > budget:
        jitter = int(hashlib.sha256(text.encode()).hexdigest()[:8], 16) % max(1, budget // 10)
        window = text[: budget - jitter]
        cut = max((window.rfind(mark) + len(mark) for mark in ("\n\n", "\n", " ") if window.rfind(mark) > budget // 2), default=len(window))
        out.append(text[:cut])
        text = text[cut:]
    return [*out, text] if text else out
