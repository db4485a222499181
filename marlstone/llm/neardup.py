"""Near-duplicate texts by one-permutation hashing, banding and candidate pairs.

Each text is a set of shingles (runs of consecutive words). One hash permutation is cut into bins;
a bin keeps its smallest value, and an empty bin borrows from a bin drawn by a hash that all texts
share (optimal densification). Bands of adjacent bins are bucket keys; the pairs of a bucket whose
sketches agree are candidates. Components of candidates are not formed: in a large table chance
candidates join most of it. Candidates whose signatures agree often enough are compared exactly.

Texts with equal shingle sets stand for each other: only one of them is bucketed.

Defined results
- Null and empty texts and texts below ``least`` words have no partner; very long texts are whole.
- A word is a maximal run of Unicode letters and digits, lower-cased.
- Repeated rows of a key count once; extra columns are not carried; empty tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from ..session import materialize

#: A maximal run of letters and digits; the standard library's engine serves texts of ASCII.
_WORD = regex.compile(r"[\p{L}\p{N}]+").findall
_ASCII_WORD = re.compile(r"[a-z0-9]+").findall
_U = np.uint64


def words(text: str) -> list[str]:
    text = text.lower()
    return _ASCII_WORD(text) if text.isascii() else _WORD(text)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values (constants of a published finaliser)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def shingles(texts: list[str | None], width: int, least: int, hashes: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(owner, hash) of the distinct shingles of each text with at least ``least`` words, sorted by both."""
    hashes = WordHashes() if hashes is None else hashes
    flat: list[int] = []
    lengths = np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        found = words(text) if text else []
        if len(found) >= max(least, width):
            lengths[i] = len(found)
            flat.extend(map(hashes.__getitem__, found))
    if not flat:
        return np.array([], dtype=np.int64), np.array([], dtype=_U)
    values = np.array(flat, dtype=_U)
    owner = np.repeat(np.arange(len(texts)), lengths)
    value = values[: len(values) - width + 1].copy()
    for k in range(1, width):
        value = _mix(value * _U(0x9E3779B97F4A7C15) + values[k : len(values) - width + 1 + k])
    whole = owner[: len(value)] == owner[width - 1 :]  # not across two texts
    owner, value = owner[: len(value)][whole], _mix(value[whole])
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    first = np.ones(len(value), dtype=bool)
    first[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return owner[first], value[first]


def signatures(owner: np.ndarray, value: np.ndarray, count: int, bins: int) -> np.ndarray:
    """One-permutation signatures (count x bins, 32 bits) with optimal densification; zeros where there is no shingle."""
    empty = _U(0xFFFFFFFFFFFFFFFF)
    out = np.full(count * bins, empty, dtype=_U)
    bin_of = ((value >> _U(32)) * _U(bins)) >> _U(32)
    slot = owner.astype(np.int64) * bins + bin_of.astype(np.int64)
    # value is ascending within an owner, hence slots are grouped and begin with their least value
    if len(slot):
        first = np.concatenate([[True], slot[1:] != slot[:-1]])
        out[slot[first]] = value[first]
    out = out.reshape(count, bins)
    holes = out == empty
    has = ~holes.all(axis=1)
    rows, cols = np.nonzero(holes & has[:, None])
    attempt = np.ones(len(rows), dtype=np.int64)
    filled = out.copy()
    while len(rows):
        donor = (_mix(cols.astype(_U) * _U(0x9E3779B97F4A7C15) + attempt.astype(_U) * _U(0xD1B54A32D192ED03)) % _U(bins)).astype(np.int64)
        ok = ~holes[rows, donor]
        filled[rows[ok], cols[ok]] = out[rows[ok], donor[ok]]
        rows, cols, attempt = rows[~ok], cols[~ok], attempt[~ok] + 1
    filled[~has] = 0
    return _mix(filled).astype(np.uint32)


def signed(texts: list[str | None], width: int, least: int, bins: int, hashes: dict) -> tuple[list[int], list[bytes], list[bytes]]:
    """Positions of the texts with enough words, the digests of their shingle sets and their signatures, 16 bits a bin."""
    owner, value = shingles(texts, width, least, hashes)
    if len(hashes) > 500_000:  # memory only
        hashes.clear()
    sig = signatures(owner, value, len(texts), bins).astype(np.uint16)
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    keep = [i for i in range(len(texts)) if bounds[i] < bounds[i + 1]]
    return keep, [xxhash.xxh3_128_digest(value[bounds[i] : bounds[i + 1]].tobytes()) for i in keep], [sig[i].tobytes() for i in keep]


def _hashed(df: DataFrame, key: str, text: str, width: int, least: int, bins: int) -> DataFrame:
    """(k, same, sig) of each text with enough words; same identifies its shingle set, sig has 16 bits a bin."""
    kind = df.schema[key].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                keep, same, sig = signed(part.column(1).to_pylist(), width, least, bins, hashes)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(keep, pa.int64())), pa.array(same, pa.binary()), pa.array(sig, pa.binary())], ["k", "same", "sig"])

    return _texts(df, key, text).mapInArrow(work, f"k {kind}, same binary, sig binary")


def _texts(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")).where("k IS NOT NULL AND t IS NOT NULL")


def _bucket_edges(sets: DataFrame, bands: int, rows: int, kind: str, threshold: float) -> DataFrame:
    """(a, b), a < b: the pairs of members of one bucket whose sketches agree.

    A sketch holds the two lowest bits of up to 64 signature bins. A pair stays if as many bins agree as
    for texts at the threshold, 6 standard errors less. Of unlike texts, whose pairs in a bucket grow as
    the square of the input, hardly any pass.
    """
    bins = bands * rows
    used = min(64, bins)
    expected = threshold + (1 - threshold) / 4
    most = int(used * (1 - expected + 6 * np.sqrt(expected * (1 - expected) / used)))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint16).reshape(n, bins).astype(_U)
            low, high = (((sig[:, :used] >> _U(bit) & _U(1)) << np.arange(used, dtype=_U)).sum(axis=1, dtype=_U).view(np.int64) for bit in (0, 1))
            banded = sig.reshape(n, bands, rows)
            value = np.broadcast_to(np.arange(bands, dtype=_U), (n, bands)).copy()
            for r in range(rows):
                value = _mix(value * _U(0x9E3779B97F4A7C15) + banded[:, :, r])
            which = np.repeat(np.arange(n), bands)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(which)), pa.array(value.reshape(-1).view(np.int64)), pa.array(low[which]), pa.array(high[which])], ["k", "bucket", "low", "high"]
            )

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last bucket may go on in the next batch
        for batch in chain(batches, [None]):
            if batch is not None:
                held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            if held is None or not held.num_rows:
                continue
            bucket = held.column("bucket").to_numpy()
            low, high = (held.column(c).to_numpy().view(_U) for c in ("low", "high"))  # of a negative number, bitwise_count takes the absolute value
            end = len(bucket) if batch is None else int(np.searchsorted(bucket, bucket[-1]))
            k = held.column("k").slice(0, end).combine_chunks()
            at, step, found, size = np.arange(end), 0, [], 0
            while len(at):
                step += 1
                at = at[: np.searchsorted(at, end - step)]
                at = at[bucket[at] == bucket[at + step]]
                near = at[np.bitwise_count((low[at] ^ low[at + step]) | (high[at] ^ high[at + step])) <= most]
                found.append((near, near + step))
                size += len(near)
                if size > 100_000 or not len(at):
                    one, two = (k.take(pa.array(np.concatenate(x))) for x in zip(*found))
                    yield pa.RecordBatch.from_arrays([one, two], ["a", "b"]).filter(pc.not_equal(one, two))
                    found, size = [], 0
            held = held.slice(end)

    members = sets.select("k", "sig").mapInArrow(keys, f"k {kind}, bucket bigint, low bigint, high bigint")
    return members.repartition("bucket").sortWithinPartitions("bucket", "k").mapInArrow(alike, f"a {kind}, b {kind}").distinct()


def _nodes(near: DataFrame) -> DataFrame:
    return near.select(F.col("a").alias("k")).union(near.select(F.col("b").alias("k"))).distinct()


def _agreeing(near: DataFrame, sigs: DataFrame, kind: str, threshold: float, bins: int) -> DataFrame:
    """The pairs whose signatures agree about as often as those of texts at the threshold, 5 standard errors less."""
    slack = 5 * np.sqrt(threshold * (1 - threshold) / bins)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if n := batch.num_rows:
                one, two = (np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint16).reshape(n, bins) for i in (2, 3))
                yield batch.select(["a", "b"]).filter(pa.array((one == two).mean(axis=1) >= threshold - slack))

    one, two = (sigs.select(F.col("k").alias(k), F.col("sig").alias(f"sig_{k}")) for k in "ab")
    return near.join(one, "a").join(two, "b").select("a", "b", "sig_a", "sig_b").mapInArrow(work, f"a {kind}, b {kind}")


def similar(
    df: DataFrame, key: str, text: str, width: int = 5, least: int = 0, threshold: float = 0.8, bands: int = 20, rows: int = 4, block: int = 256, hashed: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(members, pairs) of a table's texts.

    members: (k, rep) for each text with enough words; texts of one ``rep`` have equal shingle sets.
    pairs: (a, b, similarity), a < b: representatives with a Jaccard similarity of at least threshold.

    ``bands`` x ``rows``: two texts of similarity s share a bucket with probability
    1 - (1 - s**rows)**bands; the defaults find 99.997 % of the pairs at 0.8.
    ``hashed`` gives (k, same, sig) of the texts, as ``signed`` makes them, each once, where they are known.
    """
    kind = df.schema[key].dataType.simpleString()
    if hashed is None:
        hashed = materialize(_hashed(df, key, text, width, least, bands * rows).distinct())
    reps = hashed.groupBy("same").agg(F.min("k").alias("rep"))
    members = hashed.select("k", "same").join(reps, "same").select("k", "rep")
    sets = hashed.join(reps.select(F.col("rep").alias("k")), "k", "left_semi")
    near = materialize(_bucket_edges(sets, bands, rows, kind, threshold))
    sigs = materialize(sets.join(_nodes(near), "k", "left_semi").select("k", "sig"))
    near = materialize(_agreeing(near, sigs, kind, threshold, bands * rows))
    texts = _texts(df, key, text).join(_nodes(near), "k", "left_semi").distinct().join(sigs, "k")
    return members, _verified(texts, near, kind, threshold, bands * rows, block, width, least)


def _verified(
    texts: DataFrame, near: DataFrame, kind: str, threshold: float, bins: int, block: int, width: int, least: int
) -> DataFrame:
    """Exact similarities of the pairs in ``near``.

    The home of a text is the least of it and its candidates, so that a family has one home. Homes are
    cut into blocks of about ``block`` members. A task gets the members of one block, or of two, that
    have candidates there: no family, however large, is gathered in one task, and no text travels more
    often than it has candidates, however long the chains of these. Of a pair only the signatures are
    compared first; 5 standard errors below the threshold it is given up.
    """
    homes = near.select(F.col("b").alias("k"), F.col("a").alias("home")).union(near.select("a", "a")).groupBy("k").agg(F.min("home").alias("home"))
    sized = homes.join(homes.groupBy("home").agg(F.ceil(F.count("*") / block).alias("blocks")), "home")
    blocks = materialize(sized.select("k", F.struct("home", F.pmod(F.xxhash64("k"), F.col("blocks")).cast("int").alias("part")).alias("own")))
    one, two = (blocks.select(F.col("k").alias(k), F.col("own").alias(f"own_{k}")) for k in "ab")
    pairs = near.join(one, "a").join(two, "b").withColumns({"x": F.least("own_a", "own_b"), "y": F.greatest("own_a", "own_b")})
    ends = [pairs.select(F.col(k).alias("k"), (F.col(f"own_{k}") == F.col("x")).alias("first"), F.col("x.home").alias("x"), F.col("x.part").alias("i"), F.col("y.home").alias("y"), F.col("y.part").alias("j")) for k in "ab"]
    members = ends[0].union(ends[1]).distinct().join(texts.hint("merge"), "k")
    slack = 5 * np.sqrt(threshold * (1 - threshold) / bins)

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("k").reset_index(drop=True)
        sig = np.frombuffer(b"".join(frame["sig"]), dtype=np.uint16).reshape(len(frame), bins)
        own = frame["first"].to_numpy()
        cross = not own.all()
        owner, value = shingles(list(frame["t"]), width, least)
        bounds = np.searchsorted(owner, np.arange(len(frame) + 1))
        shingle = [value[a:z] for a, z in zip(bounds, bounds[1:])]
        size = np.array([len(s) for s in shingle])
        keys, out = frame["k"].to_numpy(), []
        for i in range(len(frame) - 1):
            near = (sig[i + 1 :] == sig[i]).mean(axis=1) >= threshold - slack
            ratio = np.minimum(size[i + 1 :], size[i]) / np.maximum(np.maximum(size[i + 1 :], size[i]), 1)
            near &= ratio >= threshold
            if cross:
                near &= own[i + 1 :] != own[i]
            for j in np.flatnonzero(near) + i + 1:
                common = len(np.intersect1d(shingle[i], shingle[j], assume_unique=True))
                score = common / (size[i] + size[j] - common)
                if score >= threshold:
                    out.append((keys[i], keys[j], score))
        return pd.DataFrame(out, columns=["a", "b", "similarity"])

    return members.groupBy("x", "i", "y", "j").applyInPandas(compare, f"a {kind}, b {kind}, similarity double")


def near_pairs(df: DataFrame, key: str, text: str, **how) -> DataFrame:
    """(a, b), a < b: all pairs of rows whose texts are similar enough, copies of a text included."""
    members, pairs = similar(df, key, text, **how)
    members = materialize(members)
    one = members.select(F.col("k").alias("a"), F.col("rep").alias("ra"))
    two = members.select(F.col("k").alias("b"), F.col("rep").alias("rb"))
    across = pairs.select(F.col("a").alias("ra"), F.col("b").alias("rb")).join(one, "ra").join(two, "rb").select("a", "b")
    copies = one.join(two, one.ra == two.rb).where("a < b").select("a", "b")
    return across.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).union(copies)


def classes(df: DataFrame, key: str, text: str, **how) -> DataFrame:
    """(k, class, links): each text with enough words, the class its links put it in, its number of similar representatives."""
    members, pairs = similar(df, key, text, **how)
    pairs = materialize(pairs)
    parts = components(pairs)
    ends = pairs.select(F.col("a").alias("rep")).union(pairs.select(F.col("b").alias("rep")))
    links = ends.groupBy("rep").agg(F.count("*").alias("links"))
    return (
        members.join(parts.select(F.col("node").alias("rep"), F.col("component").alias("class")), "rep", "left")
        .join(links, "rep", "left")
        .select("k", F.coalesce("class", "rep").alias("class"), F.coalesce("links", F.lit(0)).alias("links"))
    )
