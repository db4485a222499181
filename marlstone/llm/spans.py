"""Long verbatim spans shared between texts, by recompression.

Characters are symbols that rounds replace: a run of one symbol and a pair of a "left" and a "right"
symbol (a coin every symbol carries in a round) get a name that is a hash of what they stand for.
Names are global: equal strings get equal names in every partition and table, without a dictionary.
With each symbol goes the interval of the text that its making depended on; a window of text *owns*
the symbols whose interval lies in it, so equal windows own equal symbols. A window's anchor is the
first and the last symbol it owns of the highest kept level, down to single characters, hence every
window has one, and only windows whose anchors stand in two texts can be shared. Those windows' own
hashes are then compared in the same manner, and runs of shared windows make the spans.

Both comparisons send (hash, text, windows) packed by hash bucket; the buckets' number follows the
entries, so that none outgrows a task. Before that, each slice of texts settles the hashes that two of
its own texts hold: their windows pass by as intervals, and one witness of each hash is sent, so that a
string that stands in a third of all texts costs one entry for each slice. A text that is wholly
another's is shared from end to end; of such texts, one sends its windows for all.

Defined results
- Null, empty and short texts share nothing; blank text counts like any other; texts are whole.
- Repeats inside one text alone are not shared. Repeated rows of a key count once; if texts of one
  key differ, all of them count as its text. Keys are whole numbers; rows without key are left out.
- Equality is that of 64-bit hashes of the windows, after equality of their anchors; whole texts are
  equal if their lengths and 128-bit hashes are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

_U = np.uint64
_ODD = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
#: Pair rounds; after each, symbols are longer by a third. Before the rounds in RUNS, runs are named.
ROUNDS, RUNS, KEPT = 12, (0, 4), (12, 9, 6, 3, 0)
#: Characters of a slice, and of a bucket of anchors on average (an anchor stands for about 20); windows of a bucket.
SLICE, BUCKET, WINDOWS = 1_000_000, 8_000_000, 1_000_000
_FAR = np.int32(1 << 30)
#: Odd factors whose product's highest bit is a symbol's coin, one for each round.
_COINS = [_U((int(_ODD[2]) * (2 * i + 3)) % (1 << 64)) for i in range(ROUNDS)]
#: Characters whose rounds run together: what fits into a core's cache.
CACHED = 60_000


def _name(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _ODD[3]
    return x ^ (x >> _U(29))


def _runs(sym, dl, dr, piece):
    """Each maximal run of equal symbols becomes one; everything depends on both neighbours."""
    n = len(sym)
    new = np.ones(n, dtype=bool)
    edge = np.ones(n, dtype=bool)
    edge[1:] = piece[1:] != piece[:-1]
    new[1:] = (sym[1:] != sym[:-1]) | edge[1:]
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, n))
    last = first + count - 1
    left = np.where(edge[first], -_FAR, dl[first - 1])
    after = np.minimum(last + 1, n - 1)
    right = np.where((last + 1 == n) | edge[after], _FAR, dr[after])
    base = sym[first]
    return np.where(count > 1, _name(base * _ODD[1] + count.astype(_U) * _ODD[0]), base), left, right, piece[first]


def _pairs(sym, dl, dr, piece, number):
    """Each left symbol before a right one joins it. A left symbol has looked right, a right one left."""
    right = (sym * _COINS[number] >> _U(63)).astype(bool)
    starts = np.flatnonzero(piece[1:] != piece[:-1]) + 1
    join = right[1:] > right[:-1]
    join[starts - 1] = False
    new_l, new_r = dl.copy(), dr.copy()
    # coins are random: a choice by bits costs a fraction of one by branches
    looked = -right.astype(np.int32)
    new_l[1:] ^= (dl[1:] ^ dl[:-1]) & looked[1:]
    new_r[:-1] ^= (dr[:-1] ^ dr[1:]) & ~looked[:-1]
    begins, ends = np.append(starts, 0), np.append(starts - 1, len(sym) - 1)  # nothing stands beyond a piece
    new_l[begins[right[begins]]] = -_FAR
    new_r[ends[~right[ends]]] = _FAR
    at = np.flatnonzero(join)
    sym = sym.copy()
    sym[at] = _name(sym[at] * _ODD[0] + _name(sym[at + 1] * _ODD[1] + _ODD[2]))
    keep = np.ones(len(sym), dtype=bool)
    keep[at + 1] = False
    rest = np.flatnonzero(keep)
    return sym[rest], new_l[rest], new_r[rest], piece[rest]


def anchors(codes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first, last + 1) of the anchors of all windows of ``width`` characters.

    ``codes`` holds pieces one after the other; piece i is codes[bounds[i]:bounds[i + 1]]. Windows are
    named by their first character's index in codes.
    """
    n = len(codes)
    piece = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(bounds))
    at = np.arange(n, dtype=np.int32)
    state = (_name((codes.astype(_U) + _U(1)) * _ODD[0]), at, at + np.int32(1), piece)
    kept = {0: state}
    for number in range(ROUNDS):
        if number in RUNS:
            state = _runs(*state)
        state = _pairs(*state, number)
        if number + 1 in KEPT:
            kept[number + 1] = state
    open_ = np.zeros(n + 1, dtype=bool)
    for a, b in zip(bounds, bounds[1:]):
        open_[a : max(a, b - width + 1)] = True
    out = []
    for level in KEPT:
        sym, dl, dr, piece = kept[level]
        low, high = np.maximum(dr - width, bounds[piece]), np.minimum(dl, bounds[piece + 1] - width)
        good = low <= high  # first and last window that own the symbol
        if level != KEPT[0]:
            ahead = np.concatenate([[0], np.cumsum(open_)])
            if not ahead[-1]:
                break
            good[good] = ahead[high[good] + 1] > ahead[low[good]]
        good = np.flatnonzero(good)
        sym, low, high, dl = sym[good], low[good], high[good], dl[good]
        if not len(sym):
            continue
        # the windows from one change of the first or last owned symbol to the next have one anchor
        change = np.unique(np.concatenate([low, high + 1]))
        first, last = change[:-1], change[1:]
        one, two = np.searchsorted(high, first), np.searchsorted(low, first, side="right") - 1
        some = one <= two
        if level != KEPT[0]:
            some &= ahead[last] > ahead[first]
        first, last, one, two = first[some], last[some], one[some], two[some]
        marks = np.zeros(n + 1, dtype=np.int32)
        marks[first] += 1  # intervals do not overlap: neither their beginnings nor their ends repeat
        marks[last] -= 1
        open_ &= np.cumsum(marks) == 0
        gap = (dl[two] - dl[one]).astype(_U)
        out.append((_name(sym[one] * _ODD[0] + sym[two] * _ODD[1] + gap * _ODD[2] + _U(level)), first, last))
    if not out:
        return np.array([], dtype=_U), np.array([], dtype=np.int64), np.array([], dtype=np.int64)
    return tuple(np.concatenate(x) for x in zip(*out))


#: Bases of two independent hashes of a window, and their powers and inverse powers as far as needed so far.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    if base not in _POWERS or len(_POWERS[base][0]) <= n:
        n = max(n, 1 << 16)
        _POWERS[base] = tuple(np.cumprod(np.concatenate([[_U(1)], np.full(n, _U(x))])) for x in (base, pow(base, -1, 1 << 64)))
    return _POWERS[base]


def window_hashes(codes: np.ndarray, starts: np.ndarray, width: int, base: int = _BASES[0]) -> np.ndarray:
    """Hashes of the windows that begin at ``starts``; equal for equal windows of any text."""
    power, back = _powers(base, len(codes))
    sums = np.concatenate([[_U(0)], np.cumsum(_name((codes.astype(_U) + _U(1)) * _ODD[1]) * power[: len(codes)])])
    return _name((sums[starts + width] - sums[starts]) * back[starts])


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


def _packed(docs, first, last) -> bytes:
    """Entries ordered by (doc, first), as compressed differences."""
    parts = [np.diff(docs, prepend=0), np.diff(first, prepend=0).astype(np.int32), (last - first).astype(np.int32)]
    return len(docs).to_bytes(8, "little") + pa.compress(b"".join(x.tobytes() for x in parts), codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:8], "little")
    raw = pa.decompress(data[8:], decompressed_size=16 * n, codec="zstd", asbytes=True)
    docs = np.cumsum(np.frombuffer(raw, np.int64, n))
    first = np.cumsum(np.frombuffer(raw, np.int32, n, 8 * n).astype(np.int64))
    return docs, first, first + np.frombuffer(raw, np.int32, n, 12 * n)


def _asked(hashes, docs, first, last, bucket, octets: int) -> Iterator[pa.RecordBatch]:
    """Rows of one slice by bucket: ``octets`` bytes of each hash, packed (doc, first, last).

    The settled windows make one row, in a group of its own (a negative bucket), as intervals of each
    text; a witness of a settled hash comes with last = first - 1.
    """
    if not len(hashes):
        return
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    begin = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    size = np.diff(np.append(begin, len(ordered)))
    here = docs[order]
    several = np.minimum.reduceat(here, begin) != np.maximum.reduceat(here, begin)
    settled = np.zeros(len(hashes), dtype=bool)
    settled[order] = np.repeat(several, size)
    witness = np.zeros(len(hashes), dtype=bool)
    witness[order[begin[several]]] = True
    rows = []
    if settled.any():
        rows.append((-1 - int(ordered[0] >> _U(1)), True, b"", _packed(*_merged(docs[settled], first[settled], last[settled]))))
    end = np.where(witness, first - 1, last)
    for b, which in _grouped(bucket, ~settled | witness):
        which = which[np.lexsort((first[which], docs[which]))]
        rows.append((b, False, hashes[which].view(np.uint8).reshape(-1, 8)[:, :octets].tobytes(), _packed(docs[which], first[which], end[which])))
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["bucket", "known", "h", "at"])


def _grouped(bucket: np.ndarray, chosen: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    which = np.flatnonzero(chosen)
    which = which[np.argsort(bucket[which], kind="stable")]
    if len(which):
        for part in np.split(which, np.flatnonzero(np.diff(bucket[which])) + 1):
            yield int(bucket[part[0]]), part


_ASKED = "bucket bigint, known boolean, h binary, at binary"
_RUNS = "doc bigint, runs binary, n bigint"


def _answers(octets: int):
    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        """(doc, runs, their length) of the entries whose hash stands in two texts, of one bucket."""
        none = (np.array([], dtype=np.int64),) * 3
        gather = lambda rows: tuple(map(np.concatenate, zip(none, *map(_unpacked, rows))))
        asked = frame[~frame["known"]]
        raw = np.frombuffer(b"".join(asked["h"]), dtype=np.uint8).reshape(-1, octets)
        h = np.zeros((len(raw), 8), dtype=np.uint8)
        h[:, :octets] = raw
        h = h.reshape(-1).view(_U)
        d, a, z = gather(asked["at"])
        if len(h):
            order = np.argsort(h, kind="stable")
            h, d, a, z = h[order], d[order], a[order], z[order]
            begin = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            size = np.diff(np.append(begin, len(h)))
            several = (np.minimum.reduceat(d, begin) != np.maximum.reduceat(d, begin)) | (np.minimum.reduceat(z - a, begin) < 0)
            shared = np.repeat(several, size) & (z > a)
            d, a, z = d[shared], a[shared], z[shared]
        return _by_doc(*map(np.concatenate, zip((d, a, z), gather(frame["at"][frame["known"]]))))

    return answer


def _merge(a: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals [a, z), touching ones made one."""
    return _merged(np.zeros(len(a), dtype=np.int64), a, z)[1:]


def _merged(d: np.ndarray, a: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for the intervals of each text, ordered by text."""
    if not len(d):
        return d, a, z
    order = np.lexsort((a, d))
    d, a, z = d[order], a[order], z[order]
    base = np.cumsum(np.concatenate([[False], d[1:] != d[:-1]])) << 33  # one line, the texts far apart
    a, z = a + base, np.maximum.accumulate(z + base)
    new = np.flatnonzero(np.concatenate([[True], a[1:] > z[:-1]]))
    base = base[new]
    return d[new], a[new] - base, z[np.append(new[1:] - 1, len(a) - 1)] - base


def _by_doc(d: np.ndarray, a: np.ndarray, z: np.ndarray) -> pd.DataFrame:
    d, a, z = _merged(d, a, z)
    begin = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]])) if len(d) else np.array([], dtype=np.int64)
    both, end = np.stack([a, z]).astype(np.int64), np.append(begin[1:], len(d))
    n = np.add.reduceat(z - a, begin) if len(d) else begin
    return pd.DataFrame({"doc": d[begin].astype(np.int64), "runs": [both[:, i:j].tobytes() for i, j in zip(begin, end)], "n": n.astype(np.int64)})


def _unpack(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    parts = [np.frombuffer(p, dtype=np.int64).reshape(2, -1) for p in packed]
    return _merge(*np.concatenate(parts, axis=1))


def _copies(rows: DataFrame) -> tuple[DataFrame, int, bool]:
    """(doc, n, stands) of the texts that are wholly another key's, n their length; all characters; whether keys leave room for a bit.

    One key of each such text stands for it. Keys with differing texts take no part in this.
    """
    whole = materialize(rows.select("doc", F.unhex(F.md5("t")).alias("same"), F.length("t").alias("n")).distinct())
    total, least, most = whole.agg(F.sum("n"), F.min("doc"), F.max("doc")).first()
    single = whole.groupBy("doc").agg(F.count("*").alias("texts"), F.first("same").alias("same"), F.first("n").alias("n")).where("texts = 1").drop("texts")
    stand = single.groupBy("same", "n").agg(F.min("doc").alias("one"), F.max("doc").alias("other")).where("one <> other")
    copies = single.join(stand.hint("merge"), ["same", "n"]).select("doc", "n", (F.col("doc") == F.col("one")).alias("stands"))
    return materialize(copies), total or 0, total is None or max(-least, most) < 1 << 62


def shared_spans(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 200) -> DataFrame:
    """(key, span_start, span_end): maximal runs of characters in windows that also stand in another text."""
    rows = df.select(F.col(key).cast("bigint").alias("doc"), F.col(text).cast("string").alias("t")).where(f"doc IS NOT NULL AND length(t) >= {width}")
    copies, total, room = _copies(rows)
    if not room:
        copies = copies.limit(0)
    buckets = max(8, -(-total // BUCKET))

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            made, first = [], 0
            sizes = np.cumsum([0, *map(len, codes)])
            while first < len(codes):
                last = max(first + 1, int(np.searchsorted(sizes, sizes[first] + CACHED, side="right")) - 1)
                bounds = sizes[first : last + 1] - sizes[first]
                h, a, z = anchors(np.concatenate(codes[first:last]), bounds, width)
                which = np.searchsorted(bounds, a, side="right") - 1
                back = np.array(begins[first:last])[which] - bounds[which]
                made.append((h, np.array(docs[first:last])[which], a + back, z + back))
                first = last
            h, d, a, z = map(np.concatenate, zip(*made))
            return _asked(h, d, a, z, (h % _U(buckets)).astype(np.int64), 6)

        codes, docs, begins, held = [], [], [], 0
        for batch in batches:
            for doc, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                whole = _codes(t)
                # a long text goes in overlapping pieces: every window lies in one of them
                for begin in range(0, max(1, len(whole) - width + 1), SLICE):
                    codes.append(whole[begin : begin + SLICE + width - 1])
                    docs.append(doc), begins.append(begin)
                    held += len(codes[-1])
                    if held >= 4 * SLICE:
                        yield from flush()
                        codes, docs, begins, held = [], [], [], 0
        if codes:
            yield from flush()

    candidates = rows.mapInArrow(name, _ASKED).groupBy("bucket").applyInPandas(_answers(6), _RUNS)
    chosen = candidates.groupBy("doc").agg(F.collect_list("runs").alias("runs"), F.sum("n").alias("n"))
    # the one that stands for copies is another text than that of its key: its windows are shared wherever they are met
    chosen = chosen.join(copies.select("doc", "stands").hint("merge"), "doc", "left").where("coalesce(stands, true)")
    chosen = materialize(chosen.select("doc", "runs", "n", (F.col("doc") * 2 + F.col("stands").isNotNull().cast("int") if room else F.col("doc")).alias("name")))
    homes = max(8, -(-(chosen.agg(F.sum("n")).first()[0] or 0) // WINDOWS))
    read = rows.join(chosen.hint("merge"), "doc").select("name", "t", "runs")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            return _asked(*map(np.concatenate, (h, d, s)), np.concatenate(s) + 1, np.concatenate(g), 8)

        h, d, s, g, held = [], [], [], [], 0
        for batch in batches:
            for doc, t, runs in zip(*(batch.column(i).to_pylist() for i in range(3))):
                whole = _codes(t)
                a, z = _unpack(runs)
                z = np.minimum(z, len(whole) - width + 1)  # texts of one key may differ
                a, z = a[a < z], z[a < z]
                if not len(a):
                    continue
                size = z - a
                starts = np.repeat(a - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
                for at in range(0, len(starts), SLICE):
                    part = starts[at : at + SLICE]
                    low = part.min()
                    one, two = (window_hashes(whole[low : part.max() + width], part - low, width, base) for base in _BASES)
                    h.append(one), g.append((two % _U(homes)).astype(np.int64))
                    d.append(np.full(len(part), doc)), s.append(part)
                    held += len(part)
                    if held >= SLICE:
                        yield from flush()
                        h, d, s, g, held = [], [], [], [], 0
        if h:
            yield from flush()

    found = read.mapInArrow(compare, _ASKED).groupBy("bucket").applyInPandas(_answers(8), _RUNS)
    if room:
        found = found.where("doc % 2 = 0").withColumn("doc", F.expr("doc div 2"))
    per_doc = found.groupBy("doc").agg(F.collect_list("runs").alias("runs"))

    def spans(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            docs, starts, ends = [], [], []
            for doc, runs in zip(frame["doc"], frame["runs"]):
                a, z = _unpack(list(runs))
                a, z = _merge(a, z - 1 + width)
                docs.append(np.full(len(a), doc)), starts.append(a), ends.append(z)
            if docs:
                yield pd.DataFrame({"doc": np.concatenate(docs), "a": np.concatenate(starts), "z": np.concatenate(ends)})

    rest = per_doc.mapInPandas(spans, "doc bigint, a int, z int")
    return rest.union(copies.select("doc", F.lit(0), "n")).toDF(key, "span_start", "span_end")


def shared_share(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 200) -> DataFrame:
    """(key, n_chars, shared_chars, spans): how much of each text is shared; one row for each key."""
    spans = shared_spans(df, key, text, width).groupBy(key).agg(
        F.sum(F.col("span_end") - F.col("span_start")).alias("shared_chars"), F.count("*").alias("spans")
    )
    rows = df.select(F.col(key), F.coalesce(F.length(text), F.lit(0)).alias("n_chars")).groupBy(key).agg(F.max("n_chars").alias("n_chars"))
    zero = F.lit(0).cast("bigint")
    return rows.join(spans, key, "left").select(key, "n_chars", F.coalesce("shared_chars", zero).alias("shared_chars"), F.coalesce("spans", zero).alias("spans"))
