"""Filling containers of a fixed capacity with texts, by conflict-constrained best fit.

Items are placed in falling size. The open bins of a task are kept in order of their residual
capacity; each carries a bitmap of its sources and one of its duplicate clusters. The search begins
at the least residual that holds the item and goes on through its successors until it meets a bin
without conflict, which is the tightest compatible one:
- a bin that holds a near-duplicate of the item (five-word shingles, similarity 0.8) never takes it;
- a bin that holds the item's source takes it only if no other bin fits, so sources mix where that
  costs no container.

Tasks get equal random shares of the items, whatever their source or cluster, so that a hot source
is spread; a task leaves at most a few bins half filled, out of thousands.

Defined results
- Every row is placed, for every capacity; a text without tokens (null, empty) takes no room.
- An item larger than the capacity is cut into full pieces and a rest, numbered by ``piece``; no
  other item is cut. Repeated rows of a key count once (the largest size holds).
- Ties of size go by key. A null source is a source. Extra columns are not carried.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from ..session import materialize
from . import neardup
from .tokens import encoder, token_counts, vocabulary_path

#: Items of one task, on average.
SHARE = 20_000
#: Most capacities; each has a row of its own for every item.
LIMITS = 1_000
#: Words of a shingle and bins of a signature: those of near-duplicates by default.
WIDTH, BINS = 5, 80


class Bins:
    """Open bins of one capacity, in order of their residual capacity."""

    def __init__(self, capacity: int, room: int):
        self.capacity, self.count = capacity, 0
        self.residual = np.empty(room, dtype=np.int64)
        self.bin = np.empty(room, dtype=np.int64)
        self.sources = np.empty(room, dtype=np.uint64)
        self.clusters = np.empty(room, dtype=np.uint64)
        self.members: dict[int, set[int]] = {}

    def _columns(self):
        return self.residual, self.bin, self.sources, self.clusters

    def place(self, size: int, source: int, cluster: int) -> int:
        """Number of the bin that takes the item. ``cluster`` is negative for an item without near-duplicates."""
        n = self.count
        source_bit = np.uint64(1 << source % 64)
        cluster_bit = np.uint64(1 << cluster % 64) if cluster >= 0 else np.uint64(0)
        first = int(np.searchsorted(self.residual[:n], size))
        at = -1
        if first < n:
            clash = self.clusters[first:n] & cluster_bit != 0 if cluster >= 0 else None
            if clash is not None and clash.any():  # the bit may be another cluster's: look
                for i in np.flatnonzero(clash):
                    clash[i] = cluster in self.members.get(int(self.bin[first + i]), ())
            free = self.sources[first:n] & source_bit == 0
            for allowed in (free if clash is None else free & ~clash, None if clash is None else ~clash):
                if allowed is None:
                    at = first
                    break
                hit = int(allowed.argmax())
                if allowed[hit]:
                    at = first + hit
                    break
        if at < 0:
            number, left, sources, clusters = n, self.capacity - size, source_bit, cluster_bit
            self.count += 1
        else:
            number, left = int(self.bin[at]), int(self.residual[at]) - size
            sources, clusters = self.sources[at] | source_bit, self.clusters[at] | cluster_bit
            for column in self._columns():
                column[at : n - 1] = column[at + 1 : n]
        if cluster >= 0:
            self.members.setdefault(number, set()).add(cluster)
        n = self.count - 1
        to = int(np.searchsorted(self.residual[:n], left))
        for column, value in zip(self._columns(), (left, number, sources, clusters)):
            column[to + 1 : n + 1] = column[to:n]
            column[to] = value
        return number


def pack(sizes: np.ndarray, sources: np.ndarray, clusters: np.ndarray, capacity: int) -> pd.DataFrame:
    """(item, piece, tokens, bin) of every piece of the items; items must come in falling size."""
    full, rest = np.divmod(sizes, capacity)
    out = []
    bins = Bins(capacity, len(sizes) + int(full.sum()) + 1)
    for i in np.flatnonzero(full):
        for piece in range(int(full[i])):
            out.append((i, piece, capacity, bins.place(capacity, int(sources[i]), int(clusters[i]))))
    order = np.argsort(-np.where((rest == 0) & (full > 0), -1, rest), kind="stable")
    for i in order:
        if rest[i] or not full[i]:
            out.append((i, int(full[i]), int(rest[i]), bins.place(int(rest[i]), int(sources[i]), int(clusters[i]))))
    return pd.DataFrame(out, columns=["item", "piece", "tokens", "bin"])


def _measured(df: DataFrame, key: str, text: str, source: str, path: str) -> DataFrame:
    """(k, s, tokens, same, sig) of each row: its tokens and, where it has enough words, what tells its near-duplicates, in one pass over the texts."""
    rows = df.select(F.col(key).alias("k"), F.col(source).alias("s"), F.col(text).cast("string").alias("t"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, hashes = encoder(path), neardup.WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = part.column(2).to_pylist()
                same, sig = [None] * len(texts), [None] * len(texts)
                for i, a, b in zip(*neardup.signed(texts, WIDTH, 0, BINS, hashes)):
                    same[i], sig[i] = a, b
                columns = [part.column(0), part.column(1), pa.array(bpe.count_many(texts), pa.int64()), pa.array(same, pa.binary()), pa.array(sig, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["k", "s", "tokens", "same", "sig"])

    kinds = [rows.schema[c].dataType.simpleString() for c in ("k", "s")]
    return rows.mapInArrow(measure, f"k {kinds[0]}, s {kinds[1]}, tokens bigint, same binary, sig binary")


def classes(df: DataFrame, key: str = "doc_id", text: str = "text", hashed: DataFrame | None = None) -> DataFrame:
    """(k, class): each text with enough words and the class of near-duplicates it belongs to."""
    members, pairs = neardup.similar(df, key, text, hashed=hashed)
    members = materialize(members)
    linked = components(materialize(pairs)).toDF("rep", "class")
    return members.join(linked, "rep", "left").select("k", F.coalesce("class", "rep").alias("class"))


def filled(
    df: DataFrame, limits: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", vocabulary: str | None = None, grouped: DataFrame | None = None
) -> DataFrame:
    """(limit_id, bin_id, key, piece, tokens): the container of each text, or of each piece of a larger one.

    ``grouped`` gives the ``classes`` of the texts where they are known.
    """
    kind = df.schema[key].dataType.simpleString()
    if grouped is None:
        measured = _measured(df, key, text, source, vocabulary or vocabulary_path())
        counted = materialize(measured.groupBy("k", "same", "sig").agg(F.max(F.struct("tokens", "s")).alias("one")).select("k", "same", "sig", "one.*"))
        grouped = classes(df, key, text, counted.where("k IS NOT NULL AND same IS NOT NULL").select("k", "same", "sig"))
    else:
        counted = token_counts(df.select(F.col(key).alias("k"), F.col(source).alias("s"), F.col(text).alias("t")), "t", "tokens", vocabulary, ("k", "s"))
    sizes = materialize(counted.groupBy("k").agg(F.max(F.struct("tokens", "s")).alias("one")).select("k", "one.*"))
    several = grouped.groupBy("class").agg(F.count("*").alias("n")).where("n > 1").select("class")
    clusters = grouped.join(several, "class").select("k", F.col("class").alias("cluster"))
    share = max(1, -(-sizes.count() // SHARE))
    wanted = limits.select("limit_id", "capacity_tokens").where("capacity_tokens > 0").distinct().limit(LIMITS + 1).collect()
    if len(wanted) > LIMITS:
        raise ValueError(f"more than {LIMITS} capacities")
    limit_type = limits.schema["limit_id"].dataType.simpleString()
    each = F.from_json(F.lit(json.dumps([r.asDict() for r in wanted])), f"array<struct<limit_id:{limit_type},capacity_tokens:bigint>>")
    items = (
        sizes.join(clusters, "k", "left")
        .select("k", "tokens", F.pmod(F.xxhash64(F.coalesce("s", F.lit(""))), F.lit(1 << 40)).alias("source"), "cluster")
        .withColumn("part", F.pmod(F.xxhash64("k"), F.lit(share)))
        .withColumn("limit", F.explode(each)).select("*", "limit.*").drop("limit")
    )

    def fill(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["tokens", "k"], ascending=[False, True], kind="stable").reset_index(drop=True)
        codes, _ = pd.factorize(frame["cluster"])  # -1 for none
        found = pack(frame["tokens"].to_numpy(), frame["source"].to_numpy(), codes, int(frame["capacity_tokens"].iloc[0]))
        return pd.DataFrame(
            {
                "limit_id": frame["limit_id"].iloc[0], "bin_id": (int(frame["part"].iloc[0]) << 32) + found["bin"],
                "k": frame["k"].to_numpy()[found["item"].to_numpy(dtype=np.int64)], "piece": found["piece"], "tokens": found["tokens"],
            }
        )

    schema = f"limit_id {limit_type}, bin_id bigint, k {kind}, piece int, tokens bigint"
    return items.groupBy("limit_id", "part").applyInPandas(fill, schema).withColumnRenamed("k", key)


def audit(bins: DataFrame, df: DataFrame, limits: DataFrame, key: str = "doc_id", text: str = "text", grouped: DataFrame | None = None) -> DataFrame:
    """(limit_id, items, overfull, torn, together): what must hold of filled bins.

    overfull: bins above the capacity; torn: items in several pieces that would fit whole; together:
    pairs of near-duplicates, copies included, in one bin.
    """
    bins = materialize(bins)
    capacity = limits.select("limit_id", "capacity_tokens").distinct()
    full = bins.groupBy("limit_id", "bin_id").agg(F.sum("tokens").alias("tokens")).join(capacity, "limit_id")
    full = full.groupBy("limit_id").agg(F.count_if(F.col("tokens") > F.col("capacity_tokens")).alias("overfull"))
    items = bins.groupBy("limit_id", key).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("pieces")).join(capacity, "limit_id")
    items = items.groupBy("limit_id").agg(F.count("*").alias("items"), F.count_if((F.col("pieces") > 1) & (F.col("tokens") <= F.col("capacity_tokens"))).alias("torn"))
    known = (classes(df, key, text) if grouped is None else grouped).withColumnRenamed("k", key)
    shared = bins.select("limit_id", "bin_id", key).distinct().join(known, key).groupBy("limit_id", "bin_id", "class").agg(F.count("*").alias("n"))
    shared = shared.groupBy("limit_id").agg(F.sum(F.expr("n * (n - 1) div 2")).alias("together"))
    return items.join(full, "limit_id").join(shared, "limit_id", "left").select("limit_id", "items", "overfull", "torn", F.coalesce("together", F.lit(0)).cast("bigint").alias("together"))
