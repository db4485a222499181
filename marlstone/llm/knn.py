"""Most similar vectors by shifted space-filling curves.

Unit vectors are projected onto random orthonormal directions, squashed into a grid that is shifted
at random, and ordered along a Hilbert curve; this is done for several curves. Spark range-partitions
all (group, curve, position) keys at once; each row is compared with the rows in a window of
neighbouring keys, the windows of all curves are merged, candidates are widened by one step (the
neighbours of a neighbour), and exact cosines of the stored vectors rerank them.

Equal vectors of a group stand for each other: only the one of the smallest id is placed and searched
for, and the members of each set of copies are put in its place afterwards.

Defined results
- A vector is usable if it has ``dims`` numbers, all finite and not all zero; others have no neighbours.
- Vectors of different groups (models) are never compared; a null group is a group.
- Repeated rows of an id count once (of differing ones, one). Equal similarities rank by the smaller id;
  the similarity of copies is 1.
- Extra columns are not carried; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: The curves: how many, grid dimensions and bits each, neighbours looked at on each side.
CURVES, GRID, BITS, REACH = 12, 16, 4, 32
#: Rows on curves that one task looks through, about 30 MB.
PART = 200_000
#: What half precision may take off a cosine of unit vectors.
SLACK = 0.002


def hilbert_keys(grid: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert positions (64 bits) of the rows of an unsigned grid, most significant digits first.

    Each bit plane is walked once from the top: reflect and exchange axes by the bits met, then
    Gray-decode across axes.
    """
    axes = [grid[:, i].astype(np.uint32) for i in range(grid.shape[1])]
    dims, top = len(axes), 1 << (bits - 1)
    plane = top
    while plane > 1:
        low = np.uint32(plane - 1)
        for i in range(dims):
            high = (axes[i] & np.uint32(plane)) != 0
            swap = np.where(high, 0, (axes[0] ^ axes[i]) & low).astype(np.uint32)
            axes[0] = np.where(high, axes[0] ^ low, axes[0] ^ swap)
            if i:
                axes[i] = axes[i] ^ swap
        plane >>= 1
    for i in range(1, dims):
        axes[i] = axes[i] ^ axes[i - 1]
    flip, plane = np.zeros_like(axes[0]), top
    while plane > 1:
        flip = np.where((axes[-1] & np.uint32(plane)) != 0, flip ^ np.uint32(plane - 1), flip)
        plane >>= 1
    key = np.zeros(len(grid), dtype=np.uint64)
    for b in range(bits - 1, -1, -1):
        for axis in axes:
            key = (key << np.uint64(1)) | (((axis ^ flip) >> np.uint32(b)) & np.uint32(1)).astype(np.uint64)
    return key


def _curves(dims: int, count: int, grid: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    draw = np.random.default_rng(seed)
    return [
        (np.linalg.qr(draw.standard_normal((dims, dims)))[0][:, : min(grid, dims)].astype(np.float32), draw.uniform(0, 1, min(grid, dims)))
        for _ in range(count)
    ]


def usable_matrix(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, unit vectors) of the usable vectors of a list column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    right = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False) & (lengths == dims))
    if not len(right):
        return right, np.zeros((0, dims), dtype=np.float32)
    values = column.take(pa.array(right)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    length = np.linalg.norm(values, axis=1)
    good = np.isfinite(length) & (length > 0) & np.isfinite(values).all(axis=1)
    return right[good], (values[good] / length[good, None]).astype(np.float32)


def _usable(df: DataFrame, key: str, vector: str, group: str, dims: int) -> DataFrame:
    """(id, g, same, v): each usable vector; ``same`` identifies its numbers."""
    rows = df.select(F.col(key).alias("id"), F.coalesce(F.col(group).cast("string"), F.lit("")).alias("g"), F.col(group).isNull().alias("no"), F.col(vector).cast("array<float>").alias("v"))
    kind = rows.schema["id"].dataType.simpleString()

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, _ = usable_matrix(batch.column(3), dims)
            if not len(which):
                continue
            part = batch.take(pa.array(which))
            numbers = part.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims) + np.float32(0)  # no negative zeros
            same = pa.array([xxhash.xxh3_128_digest(row.tobytes()) for row in np.ascontiguousarray(numbers)], pa.binary())
            # a null group is a group of its own, not that of empty names
            groups = pa.array(["" if no else f"={g}" for g, no in zip(part.column(1).to_pylist(), part.column(2).to_pylist())], pa.string())
            yield pa.RecordBatch.from_arrays([part.column(0), groups, same, part.column(3)], ["id", "g", "same", "v"])

    return rows.mapInArrow(check, f"id {kind}, g string, same binary, v array<float>").where("id IS NOT NULL")


def _placed(rows: DataFrame, dims: int, curves: int, seed: int) -> DataFrame:
    """(g, curve, at, id, v): each vector of (id, g, v) once for each curve, with its position on it."""
    rows = rows.select("id", "g", "v")
    kind = rows.schema["id"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _curves(dims, curves, GRID, seed)
        for batch in batches:
            which, unit = usable_matrix(batch.column(2), dims)
            if not len(which):
                continue
            picked = pa.array(which)
            ids, groups = batch.column(0).take(picked), batch.column(1).take(picked)
            packed = pa.array([row.tobytes() for row in unit.astype(np.float16)], pa.binary())
            for number, (directions, shift) in enumerate(made):
                spread = 1 / (1 + np.exp(-1.7 * np.sqrt(dims) * (unit @ directions)))
                cells = ((spread + shift) / 2 * (1 << BITS)).astype(np.uint32)
                at = (hilbert_keys(cells, BITS) ^ np.uint64(1 << 63)).view(np.int64)  # signed order
                yield pa.RecordBatch.from_arrays(
                    [groups, pa.array(np.full(len(which), number, dtype=np.int32)), pa.array(at), ids, packed], ["g", "curve", "at", "id", "v"]
                )

    return rows.mapInArrow(place, f"g string, curve int, at bigint, id {kind}, v binary")


def _near(lane: np.ndarray, vectors: np.ndarray, ids: np.ndarray, old: int, reach: int, least: float, keep: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(a, b): pairs of rows in curve order within ``reach`` of each other, not both among the first ``old``."""
    left, right, score = [], [], []
    for step in range(1, min(reach, len(ids) - 1) + 1):
        begin = max(0, old - step)  # pairs wholly among the held rows are known
        cosine = np.einsum("ij,ij->i", vectors[begin:-step], vectors[begin + step :])
        hit = np.flatnonzero((cosine >= least - SLACK) & (lane[begin:-step] == lane[begin + step :])) + begin
        left.append(hit), right.append(hit + step), score.append(cosine[hit - begin])
    if not left:
        return ids[:0], ids[:0]
    a, b, s = map(np.concatenate, (left, right, score))
    if keep is not None and len(a):
        ends = np.concatenate([a, b])
        order = np.lexsort((-np.concatenate([s, s]), ends))
        ends = ends[order]
        rank = np.arange(len(ends)) - np.searchsorted(ends, ends)
        best = np.unique(order[rank < keep] % len(a))
        a, b = a[best], b[best]
    return np.minimum(ids[a], ids[b]), np.maximum(ids[a], ids[b])


def _lanes(names: list[str], curves: np.ndarray) -> np.ndarray:
    """A number for each (group, curve)."""
    found, code = np.unique(np.array(names, dtype=object), return_inverse=True)
    return np.array([xxhash.xxh64_intdigest(n) >> 8 for n in found], dtype=np.int64)[code] * 31 + curves


def _windows(placed: DataFrame, kind: str, dims: int, reach: int, least: float, keep: int | None, parts: int | None = None) -> DataFrame:
    """(a, b): pairs within ``reach`` keys on some curve with a cosine of about ``least`` or more.

    With ``keep``, of each row only its ``keep`` best partners in each window are given. Windows go on
    over the borders of the range partitions: each gives its first and last ``reach`` rows away, and
    those of neighbouring partitions meet afterwards.
    """
    def rows_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lane = _lanes(batch.column(0).to_pylist(), batch.column(1).to_numpy())
        vectors = np.frombuffer(b"".join(batch.column(4).to_pylist()), dtype=np.float16).reshape(-1, dims)
        return lane, vectors, batch.column(3).to_numpy(zero_copy_only=False)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            lane, vectors, ids = rows_of(batch)
            vectors = vectors.astype(np.float32)
            old = 0
            if held is not None:
                old = len(held[2])
                lane, vectors, ids = (np.concatenate([x, y]) for x, y in zip(held, (lane, vectors, ids)))
            one, two = _near(lane, vectors, ids, old, reach, least, keep)
            if len(one):
                yield pa.RecordBatch.from_arrays([pa.array(one, batch.column(3).type), pa.array(two, batch.column(3).type)], ["a", "b"])
            held = (lane[-reach:], vectors[-reach:], ids[-reach:])

    def borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The last rows of each partition and the first of the next, under the number of the border between them."""
        part, head, tail, id_type = TaskContext.get().partitionId(), None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            id_type = batch.column(3).type
            if head is None or len(head[2]) < reach:
                more = rows_of(batch.slice(0, reach))
                head = more if head is None else tuple(np.concatenate([x, y])[:reach] for x, y in zip(head, more))
            more = rows_of(batch.slice(max(0, batch.num_rows - reach)))
            tail = more if tail is None else tuple(np.concatenate([x, y])[-reach:] for x, y in zip(tail, more))
        for (lane, vectors, ids), border, side in ((tail, part, 0), (head, part - 1, 1)) if tail is not None else ():
            n = len(ids)
            packed = pa.array([v.tobytes() for v in vectors], pa.binary())
            columns = [pa.array(ids, id_type), pa.array(np.full(n, border, np.int32)), pa.array(np.arange(n, dtype=np.int32) + side * reach), pa.array(lane), packed]
            yield pa.RecordBatch.from_arrays(columns, ["a", "border", "at", "lane", "v"])

    def cross(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("at")
        vectors = np.frombuffer(b"".join(frame["v"]), dtype=np.float16).reshape(-1, dims).astype(np.float32)
        old = int((frame["at"] < reach).sum())
        one, two = _near(frame["lane"].to_numpy(), vectors, frame["a"].to_numpy(), old, reach, least, keep)
        return pd.DataFrame({"a": one, "b": two})

    # with the id, so that equal positions have an order and can be cut
    order = ["g", "curve", "at", "id"]
    ordered = (placed.repartitionByRange(parts, *order) if parts else placed.repartitionByRange(*order)).sortWithinPartitions("g", "curve", "at", "id")
    inside = ordered.mapInArrow(scan, f"a {kind}, b {kind}")
    # the same exchange is read again, for a few rows of each partition only
    over = ordered.mapInArrow(borders, f"a {kind}, border int, at int, lane bigint, v binary").groupBy("border").applyInPandas(cross, f"a {kind}, b {kind}")
    return inside.union(over).where("a <> b").distinct()


def _cosines(vectors: DataFrame, pairs: DataFrame, dims: int) -> DataFrame:
    """(a, b, similarity): exact cosines of pairs, from the stored vectors (id, v)."""
    both = pairs.join(vectors.select(F.col("id").alias("a"), F.col("v").alias("x")), "a").join(vectors.select(F.col("id").alias("b"), F.col("v").alias("y")), "b")
    kind = pairs.schema["a"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(i).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims) for i in (2, 3))
            cosine = np.einsum("ij,ij->i", x, y) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cosine)], ["a", "b", "similarity"])

    return both.select("a", "b", "x", "y").mapInArrow(score, f"a {kind}, b {kind}, similarity double")


def neighbours(
    df: DataFrame, key: str = "id", vector: str = "embedding", group: str = "model", dims: int = 64, k: int = 5,
    least: float | None = None, curves: int = CURVES, reach: int = REACH, seed: int = 7,
) -> DataFrame:
    """(id, neighbour, similarity, rank): up to k most similar vectors of each usable vector.

    With ``least``, only neighbours of at least that cosine are searched and given.
    """
    usable = _usable(df, key, vector, group, dims)
    kind = usable.schema["id"].dataType.simpleString()
    ids = usable.groupBy("id").agg(F.min(F.struct("g", "same")).alias("one")).select("id", "one.g", "one.same")
    ids = materialize(ids)
    copies = ids.groupBy("g", "same").agg(F.min("id").alias("rep"), F.count("*").alias("size"))
    members = materialize(ids.join(copies.hint("merge"), ["g", "same"]).select("id", "rep", "size", "g", "same"))
    chosen = members.where("id = rep").select("id", "g", "same")
    # by the id alone, so that the vectors are shuffled once for the join and for the distinct ids
    match = usable.join(chosen.toDF("id", "one_g", "one_same").hint("merge"), "id").where("g = one_g AND same = one_same")
    single = materialize(match.select("id", "g", "v").dropDuplicates(["id"]))

    # so many partitions that each holds about PART rows, however many there are
    parts = max(-(-single.count() * curves // PART), df.sparkSession.sparkContext.defaultParallelism)
    near = materialize(_windows(_placed(single, dims, curves, seed), kind, dims, reach, -2.0 if least is None else least, k if least is None else None, parts))
    pairs = near
    if least is not None:
        way = near.union(near.select("b", "a")).toDF("m", "e")
        wider = way.select("m", F.col("e").alias("a")).join(way.select("m", F.col("e").alias("b")), "m").where("a < b").select("a", "b")
        pairs = near.union(wider).distinct()
    scored = _cosines(single.select("id", "v"), pairs, dims)
    if least is not None:
        scored = scored.where(F.col("similarity") >= least)
    both = scored.select(F.col("a").alias("rep"), F.col("b").alias("other"), "similarity").union(
        scored.select(F.col("b").alias("rep"), F.col("a").alias("other"), "similarity")
    )
    order = Window.partitionBy("rep").orderBy(F.desc("similarity"), "other")
    best = both.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).select("rep", "other", "similarity")
    # the smallest members of each set of copies: no other can be among the k of any row
    small = members.where("size > 1").withColumn("n", F.row_number().over(Window.partitionBy("rep").orderBy("id"))).where(F.col("n") <= k + 1)
    small = small.groupBy("rep").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    shown = best.join(small.select(F.col("rep").alias("other"), "ids"), "other", "left").select(
        "rep", "similarity", F.explode(F.coalesce("ids", F.array("other"))).alias("neighbour")
    )
    if least is None or least <= 1:
        shown = shown.union(small.select("rep", F.lit(1.0).alias("similarity"), F.explode("ids").alias("neighbour")))
    lists = shown.groupBy("rep").agg(F.sort_array(F.collect_list(F.struct((-F.col("similarity")).alias("minus"), "neighbour"))).alias("list"))
    # one row of lists a set of copies: the rows of a large set stream past it
    own = members.select("id", "rep").join(lists.hint("merge"), "rep").select("id", F.slice(F.filter("list", lambda x: x["neighbour"] != F.col("id")), 1, k).alias("list"))
    each = own.select("id", F.posexplode("list").alias("at", "one"))
    return each.select("id", F.col("one.neighbour").alias("neighbour"), (-F.col("one.minus")).alias("similarity"), (F.col("at") + 1).alias("rank"))
