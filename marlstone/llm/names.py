"""Variant spellings of the names of people and organisations.

A title or slug is read as two parts: a distinguishing part (family name; an organisation's own
word) and a common part (given name; field of work). The common parts are found by counting over all
titles: words that stand in many names. Short forms come from a table, from nicknames quoted in
titles, and for fields from abbreviation (a subsequence with the same first letter).

Readings are MinHash-banded over padded q-grams of the distinguishing part under the initial of their
common part; short distinguishing parts meet on their one-letter deletions. The bands' shape comes from the collision curve: the first one that finds ``RECALL`` of the pairs at
the similarity two typing errors leave. Pairs of a bucket are verified by Monge-Elkan similarity over
edit similarities, and star clustering makes entities: the most attested readings are centres and take
their verified neighbours; readings that fit several centres stay apart.

Defined results
- Null and empty titles fall back on the slug; rows with neither, or a lone common part, have no partner.
- Titles, degrees, pronouns, legal forms, case, accents and the order of the parts make no difference.
- Repeated rows of a key count once. Ties of attestation go by the reading's text. Types never mix.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

# Words that are part of no name.
HONORIFICS = set("mr ms mrs mx miss dr prof professor sir dame herr frau mme".split())
DEGREES = set("phd mba md msc bsc jr sr esq dds jd ma ba cpa ii iii".split())
LEGAL = set("inc incorporated corp corporation co company llc ltd limited gmbh ag sa sarl bv nv plc lp llp kg oy ab pty srl spa the".split())
PARTICLES = set("van von der den de la le del di da dos al el bin ibn ter ten zu".split())

Q, ROWS, RECALL, LEFT = 2, 3, 0.99, 0.45
#: Bands from the collision curve: 1 - (1 - LEFT**ROWS)**BANDS >= RECALL.
BANDS = int(np.ceil(np.log(1 - RECALL) / np.log(1 - LEFT**ROWS)))
#: A common word stands in this share of the names of its type, and in at least so many.
COMMON_SHARE, COMMON_LEAST = 0.0005, 2
#: A short form learnt from the titles stands in this share of the names, and in at least two.
SHORT_SHARE = 0.0001
#: Least Monge-Elkan similarity of two readings, and most edits between their distinguishing parts.
SIMILAR, EDITS = 0.8, 2


def plain(text: str) -> str:
    """Lower case without accents."""
    text = unicodedata.normalize("NFKD", text.replace("ø", "o").replace("Ø", "O").replace("ß", "ss").replace("ł", "l"))
    return "".join(c for c in text if not unicodedata.combining(c)).lower()


def edits(a: str, b: str, most: int = 99) -> int:
    """Edit distance with transpositions of neighbours; anything above most counts as most + 1."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, last = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            cost = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if before and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 1)
            row.append(cost)
        if min(row) > most:
            return most + 1
        before, last = last, row
    return last[-1]


def alike(a: str, b: str) -> float:
    return 1 - edits(a, b) / max(len(a), len(b), 1)


def monge_elkan(a: list[str], b: list[str]) -> float:
    """Mean over the words of each side of the best similarity on the other, the lesser of both ways."""
    if not a or not b:
        return 0.0
    way = lambda x, y: sum(max(alike(p, q) for q in y) for p in x) / len(x)
    return min(way(a, b), way(b, a))


def _words(text: str) -> list[str]:
    return re.findall(r"[^\W\d_]+(?:'[^\W\d_]+)*\.?", plain(re.sub(r"(?<=[a-zß-ÿ])(?=[A-ZÀ-Þ][a-zß-ÿ'])", " ", text).replace("’", "'")))


_JOINED = re.compile(r"\b(Mc|Mac|O'|O’|al-|Al-|AL-)\s*([A-ZÀ-Þ])")


def _clean(text: str) -> tuple[str, str]:
    """(text without asides, quoted nickname)."""
    nick = re.search(r"[“\"‘']([^“”\"]{2,20})[”\"’'](?=\s)", text)
    text = re.sub(r"[“\"][^“”\"]*[”\"]", " ", text)
    text = re.sub(r"\((?:she|he|they|her|him|them)[^)]*\)", " ", text, flags=re.I)
    text = re.sub(r"\b([A-Za-z])\.([A-Za-z])\.(?:([A-Za-z])\.)?", lambda m: "".join(x or "" for x in m.groups()), text)  # L.L.C.
    text = _JOINED.sub(lambda m: re.sub("[’'-]", "", m[1] + m[2]).lower(), text)
    return text, plain(nick[1]) if nick else ""


def parts(title: str | None, slug: str | None, kind: str) -> tuple[list[str], list[str], bool, str]:
    """(words of the title, words of the slug, whether a comma put the family name first, nickname)."""
    text, nick = _clean(title or "")
    comma = False
    if kind == "person" and "," in text:
        head, _, rest = text.partition(",")
        if [w for w in _words(rest) if w.strip(".") not in DEGREES]:
            text, comma = f"{rest} {head}", True
        else:
            text = head
    drop = HONORIFICS | DEGREES if kind == "person" else LEGAL
    keep = lambda found: [w for w in found if w.strip(".") not in drop and w.strip(".'")]
    tail = re.sub(r"(-(?=[a-z]*\d)[0-9a-z]{1,4})+$", "", plain((slug or "").rpartition("/")[2]))
    tail = re.sub(r"\b(o|mc|al)-(?=[a-z]{4})", r"\1", tail) if kind == "person" else tail
    return keep(_words(text)), keep(re.findall(r"[a-z]+", tail)), comma, nick


class Common:
    """The common parts of one type of name and their short forms."""

    def __init__(self, kind: str, known: set[str], short: dict[str, set[str]]):
        self.kind, self.known, self.short = kind, known, short
        self.seen: dict[str, str] = {}

    def __getstate__(self):
        return self.__dict__ | {"seen": {}}

    def canon(self, word: str) -> str:
        """As ``_canon``, remembered."""
        if word not in self.seen:
            if len(self.seen) > 200_000:  # memory only
                self.seen.clear()
            self.seen[word] = self._canon(word)
        return self.seen[word]

    def _canon(self, word: str) -> str:
        """The common words that a word may stand for, joined by '/'; '' if it stands for none."""
        bare = word.strip(".")
        if len(bare) == 1:
            return bare + "."
        meant = self.short.get(bare, set())
        if meant:
            return "/".join(sorted(meant))
        if bare in self.known:
            return bare
        if self.kind != "person":
            begins = [k for k in self.known if len(bare) >= 3 and k.startswith(bare)]
            within = begins or [k for k in self.known if len(bare) < len(k) and k[0] == bare[0] and _within(bare, k)]
            if within and len(bare) <= 6:
                return "/".join(sorted(within))
        if len(bare) >= 4:
            near = [(edits(bare, k, 2), k) for k in self.known if abs(len(k) - len(bare)) <= 2 and len(k) >= 4]
            least = min(near, default=(9, ""))
            if least[0] <= (1 if len(bare) < 6 else 2):
                return least[1]
            if self.kind == "person":
                begins = [k for k in self.known if k.startswith(bare) and len(bare) >= 3]
                if len(begins) == 1:
                    return begins[0]
        elif self.kind == "person":
            begins = [k for k in self.known if k.startswith(bare) and len(bare) >= 2]
            if len(begins) == 1:
                return begins[0]
        return ""

    def reading(self, found: list[str], ordered: bool) -> tuple[str, str] | None:
        """(common, distinguishing) part of the words of a name."""
        if len(found) < 2:
            return None
        return self._person(found, ordered) if self.kind == "person" else self._company(found)

    def _person(self, found: list[str], ordered: bool) -> tuple[str, str] | None:
        first, last = self.canon(found[0]), self.canon(found[-1])
        single = lambda w: len(w.strip(".")) == 1
        flip = not ordered and (
            single(found[-1]) or found[0] in PARTICLES
            or (last and not single(found[0]) and (found[-1].strip(".") in self.known or found[-1] in self.short) and found[0].strip(".") not in self.known and found[0] not in self.short)
        )
        given, rest, common = (found[-1], found[:-1], last) if flip else (found[0], found[1:], first)
        rest = [w for w in rest if not single(w)]
        family = "".join(w.strip(".") for w in rest).replace("'", "")
        if len(family) < 2:
            return None
        return common or given.strip("."), family

    def _company(self, found: list[str]) -> tuple[str, str] | None:
        exact = [w.strip(".") in self.known for w in found]
        codes = [self.canon(w) for w in found]
        own = next((i for i, c in enumerate(codes) if not c), None)
        if own is None:
            own = next((i for i, e in enumerate(exact) if not e), None)
            if own is None:
                return None
        field = " ".join(c or w.strip(".") for i, (w, c) in enumerate(zip(found, codes)) if i != own)
        return field, found[own].strip(".").replace("'", "")


def _within(short: str, long: str) -> bool:
    rest = iter(long)
    return all(c in rest for c in short)


def fits(a: str, b: str) -> bool:
    """Whether two common parts can be one: equal, a shared meaning, an initial, or one not told."""
    if a == b or not a or not b:
        return True
    one, two = a.split(" "), b.split(" ")
    if len(one) != len(two):
        return False
    return all(_fit(x, y) for x, y in zip(one, two))


def _fit(a: str, b: str) -> bool:
    x, y = set(a.split("/")), set(b.split("/"))
    return bool(x & y) or any(p[1:] == "." and q[0] == p[0] or q[1:] == "." and p[0] == q[0] for p in x for q in y)


def vague(common: str) -> bool:
    return not common or "/" in common or "." in common


def _bands(word: str) -> list[int]:
    """Band keys of the padded q-grams of a word."""
    grams = {f"^{word}$"[i : i + Q] for i in range(len(word) + 3 - Q)}
    values = np.array([xxhash.xxh64_intdigest(g) for g in grams], dtype=np.uint64)
    seeds = _seeds()
    least = ((values[:, None] ^ (values[:, None] >> np.uint64(31))) * seeds[None, :]).min(axis=0).reshape(BANDS, ROWS)
    return [int(np.int64(np.uint64(xxhash.xxh64_intdigest(row.tobytes(), seed=i)).view(np.int64))) for i, row in enumerate(least)]


@functools.lru_cache
def _seeds() -> np.ndarray:
    return np.random.default_rng(11).integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def short_forms(shorts: DataFrame, most: int = 100_000) -> list[tuple[str, str]]:
    """The fixed table of common short forms, which is shipped whole; a table of more than ``most`` rows is refused."""
    rows = shorts.where("given IS NOT NULL AND short_form IS NOT NULL").select("given", "short_form").distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} short forms: give a table of common ones")
    return sorted((r[0], r[1]) for r in rows)


def _common(rows: DataFrame, kind: str, shorts: list[tuple[str, str]]) -> Common:
    """Counting the words of all names of one type; only those in a fixed share of names come to the driver.

    They are at most (words a name) / COMMON_SHARE, quoted nicknames likewise.
    """
    schema = "word string, first int, nick string"

    def words_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for title, slug in zip(frame["title"], frame["slug"]):
                found, _, _, nick = parts(title, slug, kind)
                found = [w.strip(".") for w in found]
                if kind != "person":
                    out += [(w, int(i > 0), None) for i, w in enumerate(found) if len(w) >= 3]
                elif len(found) >= 2:
                    out += [(found[0], 1, nick or None), (found[-1], 0, None)]
            yield pd.DataFrame(out, columns=["word", "first", "nick"])

    counted = materialize(rows.mapInPandas(words_of, schema))
    total = rows.count()
    often = max(COMMON_LEAST, COMMON_SHARE * total)
    if kind == "person":
        frequent = counted.groupBy("word").agg(F.sum("first").alias("n"), F.avg("first").alias("share")).where((F.col("n") >= often) & (F.col("share") > 0.5) & (F.length("word") >= 3))
    else:  # fields stand behind many different own words
        frequent = counted.groupBy("word").agg(F.sum("first").alias("n"), F.avg("first").alias("share")).where((F.col("n") >= max(3, 0.004 * total)) & (F.col("share") > 0.5))
    told = {r["word"]: r["n"] for r in frequent.select("word", "n").collect()}
    known = set(told)
    short: dict[str, set[str]] = {}
    if kind == "person":
        for given, form in shorts:
            short.setdefault(plain(form), set()).add(plain(given))
        known |= {plain(given) for given, _ in shorts}
        some = max(2, SHORT_SHARE * total)
        nicks = counted.where("nick IS NOT NULL AND nick <> word").groupBy("word", "nick").count().where(F.col("count") >= some).collect()
        for r in nicks:
            if r["word"] in known and r["nick"] not in short:
                short.setdefault(r["nick"], set()).add(r["word"])
        first = Common(kind, known - set(short), short)
        learnt = rows.mapInPandas(functools.partial(_two_givens, first), "a string, b string").groupBy("a", "b").count().where(F.col("count") >= some).collect()
        for r in learnt:  # the rarer of two given names of one person is short for the other
            low, high = sorted((r["a"], r["b"]), key=lambda g: told.get(g, 0))
            if high in first.known and low not in {plain(form) for _, form in shorts} and 3 * told.get(low, 0) < told.get(high, 0):
                short.setdefault(low, set()).add(high)
        for word in known - set(short):  # a common beginning of just one much commoner name
            longer = [k for k in known if k != word and k.startswith(word) and told.get(k, 0) > 3 * told.get(word, 0)]
            if len(longer) == 1 and len(word) >= 3:
                short[word] = set(longer)
        known -= set(short)
    else:  # an abbreviation can be common, too
        known -= {w for w in known if len(w) <= 6 and any(len(w) < len(k) and w[0] == k[0] and _within(w, k) and told[k] > 2 * told[w] for k in known)}
    return Common(kind, known, short)


def _two_givens(common: Common, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Given names of rows whose title and slug have one family name but different given names."""
    for frame in frames:
        out = []
        for title, slug in zip(frame["title"], frame["slug"]):
            found, tail, comma, _ = parts(title, slug, common.kind)
            a, b = common.reading(found, comma), common.reading(tail, False)
            if a and b and a[1] == b[1] and not fits(a[0], b[0]) and not vague(a[0]) and not vague(b[0]):
                out.append(tuple(sorted((a[0], b[0]))))
        yield pd.DataFrame(out, columns=["a", "b"])


def _readings(rows: DataFrame, kind: str, common: Common, key_type: str) -> DataFrame:
    """(id, node, other): each row's reading, and its slug's if that differs; 'type|common|own' each."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for key, title, slug in zip(frame["id"], frame["title"], frame["slug"]):
                found, tail, comma, _ = parts(title, slug, kind)
                readings = [r for r in (common.reading(found, comma), common.reading(tail, False)) if r]
                names = list(dict.fromkeys(f"{kind}|{r[0]}|{r[1]}" for r in readings))
                if names:
                    out.append((key, names[0], names[1] if len(names) > 1 else None))
            yield pd.DataFrame(out, columns=["id", "node", "other"])

    return rows.mapInPandas(read, f"id {key_type}, node string, other string")


def _meanings(common: str) -> set[str]:
    """What two common parts that fit share: their number of words, and an initial of the first."""
    words = common.split(" ")
    return {f"{len(words)}{meaning[:1]}" for meaning in words[0].split("/")}


def _buckets(node: str) -> list[str]:
    """The bucket keys of a reading: its own part, its one-letter deletions if it is short, MinHash bands if it is not.

    All stand under an initial of the common part, which all readings that can fit share.
    """
    kind, common, own = node.split("|")
    keys = [f"={own}"]
    if 3 <= len(own) <= 6:  # one edit apart: with one letter less, both are the same
        keys += [f"-{x}" for x in {own} | {own[:i] + own[i + 1 :] for i in range(len(own))}]
    if len(own) >= 5:
        keys += [str(x) for x in _bands(own)]
    return [f"{kind}|{m}|{k}" for m in _meanings(common) for k in keys]


def _links(nodes: DataFrame) -> DataFrame:
    """(a, b): verified pairs of readings."""

    def band(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for node in frame["node"]:
                out += [(node, bucket) for bucket in _buckets(node)]
            yield pd.DataFrame(out, columns=["node", "bucket"])

    # the readings come as one small file, but each makes dozens of rows
    tasks = max(1, nodes.sparkSession.sparkContext.defaultParallelism)
    banded = nodes.select("node").repartition(tasks).mapInPandas(band, "node string, bucket string")
    one, two = banded.toDF("a", "bucket"), banded.toDF("b", "bucket")
    # the planner knows nothing of the bands' number: a merge join keeps it from broadcasting them
    pairs = one.join(two.hint("merge"), "bucket").where("a < b").select("a", "b").distinct()

    def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keep = []
            for a, b in zip(frame["a"], frame["b"]):
                _, c1, o1 = a.split("|")
                _, c2, o2 = b.split("|")
                good = fits(c1, c2)
                if good and o1 != o2:
                    most = EDITS if min(len(o1), len(o2)) >= 6 else int(max(len(o1), len(o2)) >= 4)
                    good = edits(o1, o2, EDITS) <= most
                    # what an initial or a short form stands for was compared by its meaning
                    told = not vague(c1) and not vague(c2)
                    good = good and monge_elkan([*(c1.split() if told else []), o1], [*(c2.split() if told else []), o2]) >= SIMILAR
                keep.append(good)
            yield frame.loc[keep, ["a", "b"]]

    return pairs.mapInPandas(verify, "a string, b string")


def _stars(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, centre): star clustering of the linked readings (node, weight) over links (a, b).

    Readings are taken in order: those with one common part first, then the most attested. A reading
    becomes a centre unless a neighbour before it is one; of several it takes the first. A reading whose
    common part fits several people takes the centre of its neighbours before it if that is only one,
    counting centres of its own distinguishing part alone if there are any, else neighbours of it. All readings whose
    neighbours before them are decided are decided in one round, so no component is gathered.
    """
    common, own = (F.split_part("node", F.lit("|"), F.lit(i)) for i in (2, 3))
    unclear = (common == "") | common.contains("/") | common.contains(".")
    placed = nodes.select("node", own.alias("own"), F.struct(unclear.alias("unclear"), (-F.col("weight")).alias("minus"), F.col("node").alias("id")).alias("place"))
    both = links.select("a", "b").union(links.select("b", "a"))
    ends = both.join(placed.toDF("a", "own", "place").hint("merge"), "a").join(placed.select(F.col("node").alias("b"), F.col("place").alias("before")).hint("merge"), "b")
    up = materialize(ends.where("before < place").select(F.col("a").alias("node"), "own", "place", F.col("b").alias("other"), "before"))
    linked = both.select(F.col("a").alias("node")).distinct()
    done = new = materialize(linked.join(up, "node", "left_anti").select("node", F.col("node").alias("centre")))
    while new.limit(1).count():
        state = done.select(F.col("node").alias("other"), "centre")
        waiting = up.join(done.select("node"), "node", "left_anti").join(state.hint("merge"), "other", "left")
        own_of = lambda c: F.split_part(c, F.lit("|"), F.lit(3))
        ends = lambda name, which: (F.min(which).alias(f"{name}_low"), F.max(which).alias(f"{name}_high"))
        told = waiting.groupBy("node").agg(
            F.first("place.unclear").alias("unclear"), F.count_if(F.col("centre").isNull()).alias("open"),
            F.min(F.when((F.col("centre") == F.col("other")) & ~F.col("before.unclear"), F.col("before"))).alias("star"),
            *ends("of_own", F.when(own_of("centre") == F.col("own"), F.col("centre"))), *ends("by_own", F.when(own_of("other") == F.col("own"), F.col("centre"))), *ends("any", F.col("centre")),
        ).where("open = 0")
        low, high = F.coalesce("of_own_low", "by_own_low", "any_low"), F.coalesce("of_own_high", "by_own_high", "any_high")
        centre = F.when(F.col("unclear"), F.when(low == high, low)).otherwise(F.col("star.id"))
        new = materialize(told.select("node", F.coalesce(centre, F.col("node")).alias("centre")))
        done = done.union(new)
    return done


def entities(
    df: DataFrame, shorts: DataFrame, key: str = "id", title: str = "title", slug: str = "slug", kind: str = "type", kinds: tuple[str, ...] = ("person", "company")
) -> DataFrame:
    """(id, entity): the entity of each row of the given types that has a readable name."""
    key_type = df.schema[key].dataType.simpleString()
    table = short_forms(shorts)
    read = None
    for one in kinds:
        rows = df.where(F.col(kind) == one).select(F.col(key).alias("id"), F.col(title).alias("title"), F.col(slug).alias("slug")).where("id IS NOT NULL").distinct()
        part = _readings(rows, one, _common(rows, one, table), key_type)
        read = part if read is None else read.union(part)
    read = materialize(read)
    nodes = materialize(
        read.select("node", F.lit(1).alias("n")).union(read.where("other IS NOT NULL").select("other", F.lit(1))).groupBy("node").agg(F.sum("n").alias("weight"))
    )
    own = read.where("other IS NOT NULL").select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    links = materialize(_links(nodes).union(own.mapInPandas(_agreeing, "a string, b string")).distinct())
    return read.join(_stars(nodes, links), "node", "left").select("id", F.coalesce("centre", "node").alias("entity"))


def _agreeing(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of readings of one row that can be one name; others stay with the title."""
    for frame in frames:
        keep = [fits(a.split("|")[1], b.split("|")[1]) and edits(a.split("|")[2], b.split("|")[2], 3) <= 3 for a, b in zip(frame["a"], frame["b"])]
        yield frame.loc[keep, ["a", "b"]]


def same_pairs(df: DataFrame, shorts: DataFrame, **columns: str) -> DataFrame:
    """(a, b), a < b: every two rows of one entity."""
    members = materialize(entities(df, shorts, **columns).distinct())
    one, two = members.toDF("a", "entity"), members.toDF("b", "entity")
    return one.join(two, "entity").where("a < b").select("a", "b").distinct()
