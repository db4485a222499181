"""What callers plug in: embedders, rerankers, extractors, query expansion, parsers, sources.

A registry maps names to callables that work on batches; operators take them as arguments and run them
in Arrow batches. Nothing here calls a service: without a plug-in an operator leaves rows as they are,
and the hash embedder serves tests and offline runs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

Embedder = Callable[[Sequence[str]], np.ndarray]
Reranker = Callable[[str, Sequence[str]], Sequence[float]]
Extractor = Callable[[str], Sequence[tuple[str, str]]]
Expander = Callable[[str], Sequence[str]]


class Registry:
    """Named plug-ins of each kind."""

    KINDS = ("embedder", "reranker", "extractor", "expander", "parser", "source", "handler")

    def __init__(self):
        self._held: dict[tuple[str, str], Callable] = {}

    def add(self, kind: str, name: str, call: Callable) -> None:
        if kind not in self.KINDS:
            raise ValueError(f"no kind {kind}")
        if (kind, name) in self._held:
            raise ValueError(f"{kind} {name} is there already")
        self._held[kind, name] = call

    def get(self, kind: str, name: str) -> Callable:
        if (kind, name) not in self._held:
            raise ValueError(f"no {kind} {name}")
        return self._held[kind, name]

    def names(self, kind: str) -> list[str]:
        return sorted(n for k, n in self._held if k == kind)


REGISTRY = Registry()


def hash_embedder(texts: Sequence[str], dims: int = 64) -> np.ndarray:
    """Unit vectors of hashed words: equal texts are equal, texts that share words are near."""
    out = np.zeros((len(texts), dims), dtype=np.float32)
    for i, text in enumerate(texts):
        for word in (text or "").lower().split():
            digest = hashlib.blake2b(word.encode(), digest_size=8).digest()
            out[i, digest[0] % dims] += 1.0 if digest[1] & 1 else -1.0
    length = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(length > 0, length, 1.0)


REGISTRY.add("embedder", "hash", hash_embedder)


def embedded(df: DataFrame, key: str, text: str, embed: Embedder = hash_embedder, size: int = 256) -> DataFrame:
    """(key, embedding): vectors of texts in batches; null texts have none. The embedder is called with ``size`` texts at most."""
    kind = df.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), size):
                part = frame.iloc[at : at + size]
                yield pd.DataFrame({"k": part["k"], "embedding": list(embed(part["t"].tolist()))})

    rows = df.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")).where("t IS NOT NULL")
    return rows.mapInPandas(run, f"k {kind}, embedding array<float>").withColumnRenamed("k", key)


def reranked(hits: DataFrame, query: str, text: str, rerank: Reranker | None = None, head: int = 30) -> DataFrame:
    """A ranking (id, score, text) whose first ``head`` rows a reranker orders anew; the rest follow as they are.

    Without a reranker, or where it fails, the order stays.
    """
    order = [F.desc("score"), F.asc("id")]
    rows = hits.orderBy(*order).limit(1_000)
    if rerank is None:
        return rows.withColumn("reranked", F.lit(False))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in hits.schema) + ", reranked boolean"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = pd.concat(list(frames)).sort_values(["score", "id"], ascending=[False, True]).reset_index(drop=True)
        first = whole.iloc[:head]
        whole["reranked"] = False
        try:
            new = np.asarray(rerank(query, first[text].fillna("").tolist()), dtype=float)
            top = float(whole["score"].max()) if len(whole) else 0.0
            whole.loc[first.index, "score"] = top + 1 + new
            whole.loc[first.index, "reranked"] = True
        except Exception:  # fail open: the order that was there
            pass
        yield whole

    return rows.coalesce(1).mapInPandas(run, schema)


def extracted(df: DataFrame, key: str, text: str, extract: Extractor) -> DataFrame:
    """(key, kind, value): what an extractor finds in each text."""
    kind = df.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [(k, *found) for k, t in zip(frame["k"], frame["t"]) for found in extract(t)]
            yield pd.DataFrame(out, columns=["k", "kind", "value"])

    rows = df.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")).where("t IS NOT NULL")
    return rows.mapInPandas(run, f"k {kind}, kind string, value string").withColumnRenamed("k", key)


def variants(query: str, expand: Expander | None = None, most: int = 3) -> list[str]:
    """The query and its variants, each once."""
    return list(dict.fromkeys([query, *((expand(query) if expand else ()) or ())]))[: most + 1]


class Lines(DataSource):
    """A source of third parties in the Python data source API: records of text files that a separator parts.

    Options: ``path`` (a file or folder), ``separator`` (a line by default ``---``). One partition a file.
    """

    @classmethod
    def name(cls) -> str:
        return "marlstone_records"

    def schema(self) -> str:
        return "path string, number int, text string"

    def reader(self, schema) -> DataSourceReader:
        return _LinesReader(dict(self.options))


class _LinesReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.separator = options["path"], options.get("separator", "---")

    def partitions(self) -> Sequence[InputPartition]:
        import os

        files = [self.path] if os.path.isfile(self.path) else sorted(os.path.join(folder, f) for folder, _, names in os.walk(self.path) for f in names)
        return [InputPartition(f) for f in files]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        with open(partition.value, encoding="utf-8") as text:
            held, number = [], 0
            for line in text:
                if line.rstrip("\r\n") == self.separator:
                    yield partition.value, number, "".join(held)
                    held, number = [], number + 1
                else:
                    held.append(line)
            if held:
                yield partition.value, number, "".join(held)
