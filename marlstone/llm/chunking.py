"""Splitting oversized texts at natural boundaries, and auditing stored pieces.

Every position between two characters of a text has a boundary strength: 0 inside a word, then
rising from a word gap over clause, sentence, line and paragraph ends to headings. A sparse table of
range maxima answers "the strongest cut between i and j" at once; of equal strengths the rightmost
wins. A piece ends at the strongest cut its length permits, and the next piece begins at the
strongest cut within the permitted overlap before that end.

Defined results
- Null and empty texts have no pieces; a text within the limit is one piece, whatever it holds.
- A cut falls inside a word only if the word exceeds the limit, or if words longer than the largest
  overlap leave no way to meet limit and overlap at once.
- A text of white space only is cut like any other; no text is trimmed, so pieces are verbatim.
- Repeated rows of a key count once in the audit; extra columns are not carried.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .tokens import encoder, vocabulary_path

LIMIT, OVERLAP = 1600, (80, 240)
#: Fixed value: the characters that are not part of a word.
GAPS = " \t\r\n"
#: Boundary kinds from weakest to strongest: what stands before the cut, what follows it.
KINDS = (
    r"(?<=[,;:)\]])[ \t]+",
    r"(?<=[.!?…])[\"'”’)]*[ \t]+",
    r"\r?\n",
    r"\r?\n[ \t]*(?=[-*+>|]|\d+[.)])",
    r"\r?\n[ \t]*\r?\n[ \t\r\n]*",
    r"\r?\n(?=#{1,6} |```)",
)
_KINDS = [re.compile(k) for k in KINDS]


def strengths(text: str, limit: int = LIMIT) -> np.ndarray:
    """Strength of the cut before each position 0..len(text); 0 inside words no longer than the limit.

    A cut inside a longer word has strength 1, a plain word gap 2, further kinds more.
    """
    n = len(text)
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    gap = np.isin(codes, [ord(c) for c in GAPS])
    out = np.full(n + 1, 2, dtype=np.int64)
    inside = ~(gap[1:] | gap[:-1])
    out[1:n][inside] = 0
    edges = np.flatnonzero(np.diff(np.concatenate([[1], gap.astype(np.int8), [1]])))
    for a, b in zip(edges[::2], edges[1::2]):
        if b - a > limit:
            out[a + 1 : b] = 1
    for level, kind in enumerate(_KINDS, 3):
        ends = np.array([m.end() for m in kind.finditer(text)], dtype=np.int64)
        if len(ends):
            out[ends] = np.maximum(out[ends], np.where(out[ends] > 0, level, 0))
    out[0] = out[n] = len(_KINDS) + 3
    return out


class StrongestCut:
    """Range maxima over boundary strengths for ranges of at most ``width`` positions."""

    def __init__(self, strength: np.ndarray, width: int):
        place = len(strength)
        # value = strength * place + position: the maximum is the strongest and then the rightmost cut
        levels = [strength * place + np.arange(place)]
        span = 1
        while 2 * span <= min(width, place):
            last = levels[-1]
            levels.append(np.maximum(last[:-span], last[span:]))
            span *= 2
        self.levels, self.place, self.strength = levels, place, strength

    def query(self, first: int, last: int) -> tuple[int, int]:
        """(position, strength) of the strongest, then rightmost cut in first..last."""
        k = (last - first + 1).bit_length() - 1
        row = self.levels[k]
        value = int(max(row[first], row[last - (1 << k) + 1]))
        return value % self.place, value // self.place


def split(text: str | None, limit: int = LIMIT, overlap: tuple[int, int] = OVERLAP) -> list[tuple[int, int]]:
    """(start, end) of the pieces of a text; all within the limit, consecutive ones overlapping as stated."""
    if not text:
        return []
    n, (least, most) = len(text), overlap
    if not 0 < least <= most < limit // 2:
        raise ValueError("the overlap must be positive and less than half the limit")
    if n <= limit:
        return [(0, n)]
    strength = strengths(text, limit)
    cuts = StrongestCut(strength, limit)
    # an end is usable if some cut lies within the overlap before it
    reach = np.zeros(n + 1, dtype=np.int64)
    steps = np.concatenate([[0], np.cumsum(strength > 0)])
    at = np.arange(most, n + 1)
    reach[most:] = steps[at - least + 1] - steps[at - most]
    ends = StrongestCut(np.where(reach > 0, strength, 0), limit)
    out, start = [], 0
    while n - start > limit:
        low = start + max(limit // 2, most + 1)
        end, power = ends.query(low, start + limit)
        if not power:  # no clean end in the wished-for half: take any that moves on
            end, power = ends.query(start + most + 1, start + limit)
        if not power:  # words of nearly the limit: cut one
            end = start + limit
        out.append((start, end))
        begin, power = cuts.query(max(start + 1, end - most), end - least)
        if power and n - begin > limit and not ends.query(begin + most + 1, begin + limit)[1]:
            begin = int(np.flatnonzero(strength[: end - least + 1])[-1])  # a long word follows: leave room for it
        start = begin if power else end - least
    out.append((start, n))
    return out


def chunks(
    df: DataFrame, key: str = "id", text: str = "compiled_truth", limit: int = LIMIT, overlap: tuple[int, int] = OVERLAP, vocabulary: str | None = None
) -> DataFrame:
    """(key, chunk_index, start, end, chunk_text, token_count): the pieces of each row's text."""
    path = vocabulary or vocabulary_path()
    rows = df.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")).where("t IS NOT NULL AND t <> ''").distinct()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                keys, index, starts, ends, texts = [], [], [], [], []
                for k, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    for i, (a, b) in enumerate(split(t, limit, overlap)):
                        keys.append(k), index.append(i), starts.append(a), ends.append(b), texts.append(t[a:b])
                counts = bpe.count_many(texts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, part.column(0).type), pa.array(index, pa.int32()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64()), pa.array(texts, pa.string()), pa.array(counts, pa.int32())],
                    ["k", "chunk_index", "start", "end", "chunk_text", "token_count"],
                )

    kind = rows.schema["k"].dataType.simpleString()
    schema = f"k {kind}, chunk_index int, start bigint, end bigint, chunk_text string, token_count int"
    return rows.mapInArrow(cut, schema).withColumnRenamed("k", key)


def breaks(page: str, pieces: list[tuple[int, str]], limit: int = LIMIT, overlap: tuple[int, int] = OVERLAP) -> list[int]:
    """Indexes of the stored pieces of a page that break the contract of ``split``.

    ``pieces`` must hold every stored piece that is to be judged, and the predecessors of these.
    """
    strength = strengths(page, limit) if page else np.array([9], dtype=np.int64)
    by_index: dict[int, list[str]] = {}
    for index, piece in pieces:
        by_index.setdefault(index, []).append(piece)
    least, most = overlap
    out, near = [], 0
    for index, piece in sorted(pieces):
        wrong = len(piece) > limit
        if not wrong and piece:
            found = next((s for s, e in _places(page, piece, near) if strength[s] and strength[e]), None)
            wrong, near = found is None, near if found is None else found
        if not wrong and index > 0:
            wrong = not any(_laps(before, piece, least, most) for before in by_index.get(index - 1, ()))
        if wrong:
            out.append(index)
    return out


def _places(page: str, piece: str, near: int) -> Iterator[tuple[int, int]]:
    """Where the piece stands in the page: the places from ``near`` on (the piece before began there), then the others."""
    for first, last in ((near, len(page)), (0, near + len(piece) - 1)):
        at = page.find(piece, first, last)
        while at >= 0:
            yield at, at + len(piece)
            at = page.find(piece, at + 1, last)


def _laps(before: str, piece: str, least: int, most: int) -> bool:
    """Whether the last k characters of before are the first k of piece for some k from least to most."""
    if len(before) < least or len(piece) < least:
        return False
    tail, head = before[-most:], piece[:least]
    at = tail.find(head)
    while 0 <= at <= len(tail) - least:
        if piece.startswith(tail[at:]):
            return True
        at = tail.find(head, at + 1)
    return False


def broken_chunks(
    pages: DataFrame, stored: DataFrame, source: str = "compiled_truth", limit: int = LIMIT, overlap: tuple[int, int] = OVERLAP, block: int = 2048
) -> DataFrame:
    """(page_id, chunk_index) of the stored chunks of ``source`` that ``split`` would not have made.

    Chunks go to their page in blocks of ``block`` indexes, each with the last chunk before it, so a
    page with very many chunks is spread over tasks.
    """
    kept = (
        stored.where(F.col("chunk_source") == source)
        .select("page_id", "chunk_index", F.coalesce("chunk_text", F.lit("")).alias("piece")).distinct()
        .where("page_id IS NOT NULL AND chunk_index IS NOT NULL")
    )
    blocks = kept.select(
        "page_id", F.explode(F.expr(f"array_distinct(array(chunk_index div {block}, (chunk_index + 1) div {block}))")).alias("part"),
        F.struct("chunk_index", "piece").alias("one"),
    ).groupBy("page_id", "part").agg(F.collect_list("one").alias("pieces"))
    bodies = pages.select(F.col("id").alias("page_id"), F.col(source).alias("body")).distinct()
    kind = stored.schema["page_id"].dataType.simpleString()
    joined = blocks.join(bodies, "page_id", "left").select("page_id", "part", "body", "pieces")

    def audit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ids, indexes = [], []
            for page_id, part, body, pieces in zip(frame["page_id"], frame["part"], frame["body"], frame["pieces"]):
                found = breaks(body or "", [(p["chunk_index"], p["piece"]) for p in pieces], limit, overlap)
                found = [i for i in found if i // block == part]
                ids += [page_id] * len(found)
                indexes += found
            yield pd.DataFrame({"page_id": ids, "chunk_index": indexes})

    return joined.mapInPandas(audit, f"page_id {kind}, chunk_index int").distinct()


def audit(df: DataFrame, made: DataFrame, key: str = "id", text: str = "compiled_truth") -> DataFrame:
    """(texts, chars, broken, miscounted), one row: what must hold of the pieces of ``chunks``.

    texts and chars: texts with pieces, and the characters these cover from the first one's start to
    the last one's end; broken: pieces against the contract; miscounted: another number of pieces than
    the last index tells.
    """
    made = materialize(made)
    stored = made.select(F.col(key).alias("page_id"), "chunk_index", F.col("chunk_text"), F.lit(text).alias("chunk_source"))
    wrong = broken_chunks(df.withColumnRenamed(key, "id"), stored, text).agg(F.count("*").alias("broken"))
    each = made.groupBy(key).agg((F.max("end") - F.min("start")).alias("chars"), F.count("*").alias("n"), F.max("chunk_index").alias("last"))
    whole = each.agg(F.count("*").alias("texts"), F.coalesce(F.sum("chars"), F.lit(0)).cast("bigint").alias("chars"), F.count_if(F.col("n") != F.col("last") + 1).alias("miscounted"))
    return whole.crossJoin(wrong).select("texts", "chars", "broken", "miscounted")  # one row each
