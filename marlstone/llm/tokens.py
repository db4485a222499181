"""Encoding texts with a public byte-level BPE vocabulary.

A vocabulary file gives each byte string a rank, which is also its id. A pre-token's bytes form a
doubly linked list of symbols; a priority queue holds the adjacent pairs that the vocabulary knows,
lowest rank first. An entry whose symbols have changed since it was queued is stale and skipped.
Pairs of a short pre-token are looked through instead, and one that is in the vocabulary is one id.

Defined results: null and empty texts give an empty list; any other text, however long, is encoded
whole; strings that look like special tokens are ordinary text. Repeated rows are encoded alike.
"""

from __future__ import annotations

import base64
import functools
import heapq
import itertools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the pre-token pattern published with the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pre-tokens a worker remembers before it starts afresh; bounds memory only, never results.
REMEMBERED = 400_000
#: Above every rank.
NEVER = 1 << 30
#: Bytes of a pre-token whose pairs are looked through each time: less work than a queue of so few.
SHORT = 32
#: Rows encoded at a time by one worker.
SLICE = 500


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Where a vocabulary file of the installed public_tokenizers lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _plane_pattern(last: int) -> re.Pattern:
    """The published pattern for the standard library's engine, right for texts of code points up to last.

    The classes L, N and white space are spelled out as ranges of the code points that the published
    pattern's engine puts into them, so both engines split alike.
    """
    every = "".join(map(chr, [*range(min(last + 1, 0xD800)), *range(0xE000, last + 1)]))

    def ranges(kind: str) -> str:
        points = np.array([ord(x) for x in regex.findall(kind, every)])
        cuts = np.flatnonzero(np.diff(points) != 1) + 1
        return "".join(rf"\u{p[0]:04x}-\u{p[-1]:04x}" for p in np.split(points, cuts))

    letters, digits, spaces = ranges(r"\p{L}"), ranges(r"\p{N}"), ranges(r"\s")
    pattern = PATTERN
    for kind, points in (
        (r"[^\s\p{L}\p{N}]", f"[^{spaces}{letters}{digits}]"), (r"\p{L}", f"[{letters}]"), (r"\p{N}", f"[{digits}]"),
        (r"\S", f"[^{spaces}]"), (r"\s", f"[{spaces}]"),
    ):
        pattern = pattern.replace(kind, points)
    return re.compile(pattern)


def _splitter():
    """Pre-tokens of a text by the fastest engine that is right for its characters."""
    ascii_only, one_plane = _plane_pattern(0x7F).findall, _plane_pattern(0xFFFF).findall
    further, general = re.compile("[\U00010000-\U0010ffff]").search, regex.compile(PATTERN).findall

    def split(text: str) -> list[str]:
        if text.isascii():
            return ascii_only(text)
        return general(text) if further(text) else one_plane(text)

    return split


class ByteBPE:
    """Encoder and decoder over a rank file (base64 bytes and rank on each line)."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.strings = {rank: text for text, rank in self.ranks.items()}
        self.letter = [self.ranks[bytes([b])] for b in range(256)]
        self.split = _splitter()
        self.pairs = _Pairs(self.ranks, self.strings)
        self.known = _Known(self.merge)

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token.

        ``at[i]`` is the id of the symbol that begins at i; a queue entry rank * n + i is stale unless
        ``offered[i]`` still holds its rank.
        """
        whole = self.ranks.get(word)
        if whole is not None:  # as the public library has it
            return [whole]
        n, pairs = len(word), self.pairs
        at = list(map(self.letter.__getitem__, word))
        if n <= SHORT:
            ranks = [pairs[a << 20 | b] for a, b in zip(at, at[1:])]
            while ranks and (rank := min(ranks)) < NEVER:
                i = ranks.index(rank)  # the leftmost, as in the queue
                at[i : i + 2] = (rank,)
                del ranks[i]
                if i < len(ranks):
                    ranks[i] = pairs[rank << 20 | at[i + 1]]
                if i:
                    ranks[i - 1] = pairs[at[i - 1] << 20 | rank]
            return at
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        offered = [pairs[a << 20 | b] for a, b in zip(at, at[1:])]
        offered.append(NEVER)
        queue = [rank * n + i for i, rank in enumerate(offered) if rank < NEVER]
        heapq.heapify(queue)
        while queue:
            rank, i = divmod(heapq.heappop(queue), n)
            if offered[i] != rank:
                continue
            j = after[i]
            at[i] = rank
            offered[j] = NEVER
            k = after[i] = after[j]
            at[j] = -1
            if k < n:
                before[k] = i
                offered[i] = new = pairs[rank << 20 | at[k]]
                if new < NEVER:
                    heapq.heappush(queue, new * n + i)
            else:
                offered[i] = NEVER
            h = before[i]
            if h >= 0:
                offered[h] = new = pairs[at[h] << 20 | rank]
                if new < NEVER:
                    heapq.heappush(queue, new * n + h)
        return [x for x in at if x >= 0]

    def encode(self, text: str | None) -> list[int]:
        return list(itertools.chain.from_iterable(map(self.known.__getitem__, self.split(text or ""))))

    def encode_many(self, texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of many texts; the ids of text i are ids[offsets[i]:offsets[i + 1]]."""
        flat: list[int] = []
        offsets = [0]
        for text in texts:
            if text:
                flat.extend(itertools.chain.from_iterable(map(self.known.__getitem__, self.split(text))))
            offsets.append(len(flat))
        self.known.trim()
        return np.array(offsets, dtype=np.int32), np.array(flat, dtype=np.int32)

    def count_many(self, texts: Iterable[str | None]) -> np.ndarray:
        """Number of ids of each text."""
        get = self.known.__getitem__
        counts = np.array([sum(map(len, map(get, self.split(t)))) if t else 0 for t in texts], dtype=np.int64)
        self.known.trim()
        return counts

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", errors="replace")


class _Pairs(dict):
    """Rank of the union of two adjacent symbols by their ids, NEVER where the vocabulary lacks it."""

    def __init__(self, ranks: dict[bytes, int], strings: dict[int, bytes]):
        super().__init__()
        self.ranks, self.strings = ranks, strings

    def __missing__(self, key: int) -> int:
        rank = self.ranks.get(self.strings[key >> 20] + self.strings[key & 0xFFFFF], NEVER)
        if len(self) > REMEMBERED:
            self.clear()
        self[key] = rank
        return rank


class _Known(dict):
    """Ids by pre-token, computed when first asked for."""

    def __init__(self, merge):
        super().__init__()
        self.merge = merge

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = tuple(self.merge(word.encode("utf-8")))
        if len(word) <= 64:
            self[word] = ids
        return ids

    def trim(self) -> None:
        if len(self) > REMEMBERED:
            self.clear()


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> ByteBPE:
    """The encoder of a vocabulary file, loaded once in each worker."""
    return ByteBPE(path)


def token_ids(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(key, ids array<int>): one row for each row of df; other columns are not carried."""
    path = path or vocabulary_path()
    source = df.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    kind = pa.list_(pa.int32())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                offsets, ids = bpe.encode_many(part.column(1).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())).cast(kind)
                yield pa.RecordBatch.from_arrays([part.column(0), lists], ["k", "ids"])

    key_type = source.schema["k"].dataType.simpleString()
    return source.mapInArrow(encode, f"k {key_type}, ids array<int>").select(F.col("k").alias(key), "ids")


def token_counts(
    df: DataFrame, text: str = "text", out: str = "tokens", path: str | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """The columns ``keep`` of df and the number of tokens of each row's text (0 for null and empty)."""
    path = path or vocabulary_path()
    source = df.select(*[F.col(c) for c in keep], F.col(text).cast("string").alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                n = bpe.count_many(part.column(part.num_columns - 1).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(n, pa.int64())], [*keep, out])

    return source.mapInArrow(count, f"{fields + ', ' if fields else ''}`{out}` bigint")
