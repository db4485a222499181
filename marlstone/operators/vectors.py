"""Exact nearest vectors of a stated query set, in blocks.

Rows and queries are cut into blocks by hash; every block of queries meets every block of rows once,
in one matrix product a slice. A block has a fixed number of rows, so tasks stay alike at every size
and a group of any size is spread.

Defined results
- A vector is usable if it has ``dims`` numbers, all finite and not all zero; others are left out.
- Vectors of different groups are never compared; a null group is a group of its own.
- Repeated rows of an id count once (of differing ones, the one of smallest bytes). Equal
  similarities rank by the smaller id. Extra columns are not carried; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: Rows and queries of a block, and queries of one matrix product.
ROWS, QUERIES, SLICE = 100_000, 20_000, 128


def _packed(df: DataFrame, key: str, vector: str, group: str | None, dims: int) -> DataFrame:
    """(id, g, v): the usable vectors as single precision bytes."""
    name = F.concat(F.lit("="), F.col(group).cast("string")) if group else F.lit("=")
    rows = df.select(F.col(key).alias("id"), F.coalesce(name, F.lit("")).alias("g"), F.col(vector).cast("array<float>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & (F.size("v") == dims))
    kind = rows.schema["id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, dims)
            good = np.isfinite(values).all(axis=1) & (values != 0).any(axis=1)
            picked = pa.array(np.flatnonzero(good))
            packed = pa.array([row.tobytes() for row in values[good]], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(picked), batch.column(1).take(picked), packed], ["id", "g", "v"])

    return rows.mapInArrow(pack, f"id {kind}, g string, v binary")


def _distinct(table: pa.Table, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids ascending, vectors) of a table (id, v), one row an id."""
    ids = table["id"].to_numpy()
    values = table["v"].to_pylist()
    order = sorted(range(len(ids)), key=lambda i: (ids[i], values[i]))
    keep = [i for n, i in enumerate(order) if not n or ids[order[n - 1]] != ids[i]]
    return ids[keep], np.frombuffer(b"".join(values[i] for i in keep), dtype=np.float32).reshape(-1, dims)


def _best(rows: pa.Table, queries: pa.Table, dims: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, neighbour id, cosine) of the k best rows of this block for each query."""
    ids, values = _distinct(rows, dims)
    asked, wanted = _distinct(queries, dims)
    # copies are one row of the product; of each set the k + 1 smallest ids can be among the k best
    bits = np.ascontiguousarray(values).view(np.dtype((np.void, values.itemsize * dims))).reshape(-1)
    _, first, which = np.unique(bits, return_index=True, return_inverse=True)
    order = np.argsort(which, kind="stable")
    begins = np.searchsorted(which[order], np.arange(len(first) + 1))
    single = values[first].astype(np.float64)
    unit = (single / np.linalg.norm(single, axis=1)[:, None]).astype(np.float32)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for at in range(0, len(asked), SLICE):
        part = wanted[at : at + SLICE].astype(np.float64)
        rough = (part / np.linalg.norm(part, axis=1)[:, None]).astype(np.float32) @ unit.T
        place = min(k + 1, rough.shape[1])
        bound = np.partition(rough, rough.shape[1] - place, axis=1)[:, rough.shape[1] - place]
        left, right = np.nonzero(rough >= bound[:, None] - 1e-5)
        x, y = part[left], single[right]
        cosine = np.einsum("ij,ij->i", x, y) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1))
        size = np.minimum(begins[right + 1] - begins[right], k + 1)
        pick = np.repeat(begins[right], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        who, other, cosine = np.repeat(left, size), ids[order[pick]], np.repeat(cosine, size)
        differ = other != asked[at + who]
        who, other, cosine = who[differ], other[differ], cosine[differ]
        sort = np.lexsort((other, -cosine, who))
        who, other, cosine = who[sort], other[sort], cosine[sort]
        top = np.arange(len(who)) - np.searchsorted(who, who) < k
        out.append((asked[at + who[top]], other[top], cosine[top]))
    return tuple(map(np.concatenate, zip(*out)))


def nearest_of(df: DataFrame, asked: Column, key: str = "id", vector: str = "embedding", group: str | None = None, dims: int = 64, k: int = 10) -> DataFrame:
    """(id, neighbour, similarity, rank): the k rows most similar to each row for which ``asked`` (over ``id``) holds.

    All rows of df are searched, exactly; a row is not its own neighbour.
    """
    packed = materialize(_packed(df, key, vector, group, dims))
    kind = packed.schema["id"].dataType.simpleString()
    n = packed.agg(F.count("*").alias("rows"), F.count_if(asked).alias("asked")).first()
    parts, blocks = max(1, -(-n["rows"] // ROWS)), max(1, -(-n["asked"] // QUERIES))
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    rows = packed.select("id", "g", "v", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"), every(blocks).alias("block"))
    queries = packed.where(asked).select("id", "g", "v", every(parts).alias("part"), F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["id", "neighbour", "similarity"]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], left["id"].type), pa.array([], left["id"].type), pa.array([], pa.float64())], names)
        a, b, s = _best(left, right, dims, k)
        return pa.table([pa.array(a, left["id"].type), pa.array(b, left["id"].type), pa.array(s)], names)

    by = ["g", "part", "block"]
    found = rows.groupBy(*by).cogroup(queries.groupBy(*by)).applyInArrow(search, f"id {kind}, neighbour {kind}, similarity double")
    order = Window.partitionBy("id").orderBy(F.desc("similarity"), "neighbour")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
