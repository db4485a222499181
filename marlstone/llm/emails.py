"""The newly written text of each email.

Three kinds of evidence decide line by line:
1. Structure. Lines behind a quote mark, the lines that introduce them, and everything below an
   unmarked message header are earlier messages; a closing formula or a signature delimiter begins a
   signature that lasts until the next quoted part.
2. Ancestors. Own text (without the notices of 3) is winnowed into fingerprints of word runs; a
   corpus-wide inverted index maps each fingerprint to the messages that hold it as own text. Own
   lines that verify word by word as text of other messages found there, in stretches of SPAN words
   or of another message's whole own text, are quoted history without marks, and so are the lines
   that introduce them. No thread identifier is used.
3. Recurrence. A line of some length that a hundredth of all messages carry outside quotes is a
   standing notice, whatever its language.

Defined results
- Null, empty and blank mails have no new lines; blank lines are never given; lines are numbered from
  1 after splitting at LF (a CR before it belongs to the line end).
- Greetings are new text. Ties do not arise: a line is new or not. Repeated rows of a key count once.
- A mail that consists of quoted text alone has no new lines. Texts are processed whole.
- Of two mails that share own text, the one that holds the other's whole and more has the copy, else
  the later one; mails of equal own text keep it both.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .neardup import words

# The phrases mail programs and writers use around quoted text and signatures.
CLOSINGS = (
    "best", "best regards", "best wishes", "kind regards", "warm regards", "regards", "br", "cheers", "thanks", "many thanks", "thank you", "talk soon",
    "sincerely", "yours", "yours truly", "cordialement", "bien à vous", "amicalement", "saludos", "atentamente", "un saludo", "viele grüße", "liebe grüße",
    "mit freundlichen grüßen", "beste grüße", "mfg", "lg", "vg", "gruß", "cumprimentos", "abraços",
)
# Words behind "thanks", "best" and the like that go on with a sentence.
NO_NAMES = set(
    "a again all also and any as at before both but by can every everybody everyone everything ever folks for from good guys have having i idea in is it much of on one option or our out part place "
    "plenty possible practice price so still team that the them then there these they things this those though time to too us very way we who with you your".split()
)
DEVICE_NOTES = r"sent from (?:my|a)\b|von unterwegs gesendet|von meinem \w+ gesendet|envoyé de(?:puis)? mon|enviado desde mi|get outlook for"
SEPARATORS = r"-{2,}\s*(?:original message|forwarded message|weitergeleitete nachricht|ursprüngliche nachricht|message d'origine|message transféré|mensaje reenviado|mensaje original)\s*-{2,}|begin forwarded message:"
SENDER_KEYS, OTHER_KEYS = "from|von|de|da", "sent|date|gesendet|datum|envoyé|enviado|fecha|to|an|à|para|subject|betreff|objet|asunto|cc"

_MARK = re.compile(r"\s*[>|]")
_INTRO = re.compile(
    r"\s*(?:(?:on|le|am|el|em)\b.*(?:wrote|a écrit|escribió|escreveu)\s*:|am\b.*\bschrieb\b.*:|.*\bwrote on \d{4}-\d\d-\d\d:|\* .+ \[[\d\-: ]+\]:|.*\bwrote\s*:)\s*$", re.I
)
_INTRO_HEAD = re.compile(r"\s*(?:On|Le|Am|El|Em)\b.*\d")
_SEPARATOR = re.compile(rf"\s*(?:{SEPARATORS})\s*$", re.I)
_RULE = re.compile(r"\s*_{8,}\s*$")
_SENDER = re.compile(rf"\s*(?:{SENDER_KEYS})\s?:\s*\S", re.I)
_OTHER = re.compile(rf"\s*(?:{OTHER_KEYS})\s?:", re.I)
_CLOSING = re.compile(rf"\s*(?:{'|'.join(sorted(CLOSINGS, key=len, reverse=True))})(?:\s*[,!.]|(?=\s|$))\s*((?:\S+\s*){{0,4}})$", re.I)
_DELIMITER = re.compile(r"\s*(?:-{2,}|_{2,}|[—–]|={3,}|\*{3,})\s*$")
_DEVICE = re.compile(rf"\s*(?:{DEVICE_NOTES})", re.I)

OWN, QUOTED, SIGNATURE, DEVICE, BLANK = range(5)
#: Words of a fingerprinted run, and fingerprints among which the least is kept.
RUN, WINDOW = 8, 4
#: Share of the mails, and mails, that must carry a standing notice; words it must have.
NOTICE_SHARE, NOTICE_LEAST, NOTICE_WORDS = 0.01, 5, 3
#: Words of a copied stretch; shorter ones are the same by chance where they are not another mail's whole text.
SPAN = 20


def lines_of(text: str | None) -> list[str]:
    return [line.rstrip("\r") for line in (text or "").split("\n")]


def _header_at(lines: list[str], i: int) -> bool:
    """Whether an unmarked header of an earlier message begins at line i."""
    if _SEPARATOR.match(lines[i]):
        return any(_SENDER.match(x) or _OTHER.match(x) for x in lines[i + 1 : i + 4])
    if _RULE.match(lines[i]):
        return i + 2 < len(lines) and bool(_SENDER.match(lines[i + 1]) and _OTHER.match(lines[i + 2]))
    return bool(_SENDER.match(lines[i])) and i + 2 < len(lines) and bool(_OTHER.match(lines[i + 1]) and _OTHER.match(lines[i + 2]))


def structure(lines: list[str]) -> list[int]:
    """The kind of each line by structure alone."""
    n = len(lines)
    kinds = [BLANK if not line.strip() else OWN for line in lines]
    # which mark quotes in this mail: the one that follows an introduction; '>' always does
    bars = False
    for i, line in enumerate(lines):
        if _INTRO.match(line):
            after = next((x for x in lines[i + 1 :] if x.strip()), "")
            bars = bars or after.lstrip().startswith("|")
    for i, line in enumerate(lines):
        mark = line.lstrip()[:1]
        if mark == ">" or (mark == "|" and bars):
            kinds[i] = QUOTED
    for i in range(n):
        if kinds[i] == OWN and _header_at(lines, i):
            for j in range(i, n):
                kinds[j] = QUOTED if kinds[j] != BLANK else BLANK
            break
    for i in range(n):  # introductions: the lines before a quoted part
        if kinds[i] != OWN or not _INTRO.match(lines[i]):
            continue
        j = next((j for j in range(i + 1, n) if kinds[j] != BLANK), n)
        if j == n or kinds[j] == QUOTED:
            kinds[i] = QUOTED
            if not _INTRO_HEAD.match(lines[i]) and not lines[i].lstrip().startswith("*") and i and kinds[i - 1] == OWN and _INTRO_HEAD.match(lines[i - 1]):
                kinds[i - 1] = QUOTED
    signing = False
    for i in range(n):
        if kinds[i] == QUOTED:
            signing = False
        elif kinds[i] == OWN:
            if _DEVICE.match(lines[i]):
                kinds[i] = DEVICE
            elif signing:
                kinds[i] = SIGNATURE
            elif _DELIMITER.match(lines[i]) or _closes(lines, kinds, i):
                kinds[i] = SIGNATURE
                signing = True
    return kinds


def _closes(lines: list[str], kinds: list[int], i: int) -> bool:
    """A closing formula: alone before a short line, or with a name behind it."""
    found = _CLOSING.match(lines[i])
    if not found:
        return False
    after = next((lines[j] for j in range(i + 1, len(lines)) if kinds[j] == OWN), "")
    short = len(after.split()) <= 6 or bool(_DEVICE.match(after))
    if not found[1]:
        return short
    if not _signs(found[1].split()):
        return False
    # a name in its middle opens or goes on with a sentence; a notice stands apart
    joined = i + 1 < len(lines) and kinds[i + 1] == OWN
    return (short or not joined) and (not after or any(k == OWN for k in kinds[:i]))


def _signs(found: list[str]) -> bool:
    """Whether the words behind a formula can be a name: capitalised, or one or two words that no sentence goes on with."""
    if any(not re.fullmatch(r"[^\W\d_][\w'’.\-]*,?", w) for w in found) or len(found) > 3:
        return False
    small = [w for w in found if w[0].islower()]
    return not small or (len(found) <= 2 and not any(w.strip(".,").lower() in NO_NAMES for w in found))


def run_hashes(text: str) -> np.ndarray:
    """Hashes of all runs of RUN words of a text, in order."""
    found = words(text)
    return np.array([xxhash.xxh64_intdigest(" ".join(found[i : i + RUN])) for i in range(len(found) - RUN + 1)], dtype=np.uint64).view(np.int64)


def fingerprints(hashes: np.ndarray) -> list[int]:
    """The winnowed ones of a text's run hashes (least of each window, rightmost of equals)."""
    if len(hashes) <= WINDOW:
        return [int(hashes.min())] if len(hashes) else []
    views = np.lib.stride_tricks.sliding_window_view(hashes, WINDOW)
    at = np.arange(len(views)) + WINDOW - 1 - views[:, ::-1].argmin(axis=1)
    return [int(x) for x in np.unique(hashes[np.unique(at)])]


def _line_hash(line: str) -> int:
    return int(np.int64(np.uint64(xxhash.xxh64_intdigest(" ".join(line.lower().split()))).view(np.int64)))


def _marks(mails: DataFrame, kind: str) -> DataFrame:
    """(id, mark): the hash of every unquoted line that is long enough for a standing notice."""

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for key, text in zip(frame["id"], frame["text"]):
                lines = lines_of(text)
                out += [(key, _line_hash(x)) for x, k in zip(lines, structure(lines)) if k not in (BLANK, QUOTED) and len(x.split()) >= NOTICE_WORDS]
            yield pd.DataFrame(out, columns=["id", "mark"])

    return mails.mapInPandas(parse, f"id {kind}, mark bigint")


def _own(mails: DataFrame, kind: str, notices: set[int]) -> DataFrame:
    """(id, uid, at, body, numbers, lines, runs, prints): the own lines of each mail without standing notices, their run hashes and fingerprints.

    body is a hash of their words.
    """

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for key, uid, at, text in zip(frame["id"], frame["uid"], frame["at"], frame["text"]):
                lines = lines_of(text)
                own = [(i, x) for i, (x, k) in enumerate(zip(lines, structure(lines)), 1) if k == OWN and _line_hash(x) not in notices]
                if own:
                    text = "\n".join(x for _, x in own)
                    body = xxhash.xxh3_128_digest(" ".join(words(text)))
                    runs = run_hashes(text)
                    out.append((key, uid, at, body, [i for i, _ in own], [x for _, x in own], runs, fingerprints(runs)))
            yield pd.DataFrame(out, columns=["id", "uid", "at", "body", "numbers", "lines", "runs", "prints"])

    return mails.mapInPandas(parse, f"id {kind}, uid string, at string, body binary, numbers array<int>, lines array<string>, runs array<bigint>, prints array<bigint>")


def history(lines: list[str], others: list[tuple[list[str], bool]]) -> list[int]:
    """The positions of those own lines that stand in another mail's own text (lines, whether it is the earlier mail).

    Two mails that hold the same own text (or one wholly the other's) are told apart by what they add:
    the one that holds more has the copy. Otherwise the later one has it.
    """
    each = [words(x) for x in lines]
    mine = [w for found in each for w in found]
    whole = f" {' '.join(mine)} "
    runs: set[tuple[str, ...]] = set()
    hit = np.zeros(len(mine) + 1, dtype=bool)  # hit[i]: word i and the one before it belong to one copied stretch
    inside = np.zeros(len(mine), dtype=bool)

    def mark(begin: int, end: int) -> None:
        inside[begin:end] = True
        hit[begin + 1 : end] = True

    for other, earlier in others:
        theirs = [w for x in other for w in words(x)]
        text = f" {' '.join(theirs)} "
        if whole in text:
            continue
        if len(theirs) >= RUN and text in whole:
            at = whole.find(text)
            while at >= 0:
                begin = whole.count(" ", 0, at + 1) - 1
                mark(begin, begin + len(theirs))
                at = whole.find(text, at + 1)
        elif earlier:
            runs.update(tuple(theirs[i : i + RUN]) for i in range(len(theirs) - RUN + 1))
    begin = None
    for i in range(len(mine) - RUN + 2):
        if i <= len(mine) - RUN and tuple(mine[i : i + RUN]) in runs:
            begin = i if begin is None else begin
        elif begin is not None:
            if i - 1 + RUN - begin >= SPAN:
                mark(begin, i - 1 + RUN)
            begin = None
    out, at = [], 0
    for i, found in enumerate(each):
        end = at + len(found)
        if inside[at:end].all() if found else hit[at]:
            out.append(i)
        at = end
    gone = set(out)
    for i in out:  # the lines that introduce it
        if i and i - 1 not in gone and _INTRO.match(lines[i - 1]):
            gone.add(i - 1)
            if i > 1 and not _INTRO_HEAD.match(lines[i - 1]) and not lines[i - 1].lstrip().startswith("*") and _INTRO_HEAD.match(lines[i - 2]):
                gone.add(i - 2)
    return sorted(gone)


def _held(bodies: DataFrame) -> DataFrame:
    """(body, long, all): whether other texts hold each run of a stretch of SPAN words of a text, or of the whole text.

    A text without such a stretch copies none, and one that is not held wholly is no other's part, so
    these alone need a comparison, however many texts share a run by chance.
    """
    runs = bodies.select(F.xxhash64("body").alias("b"), F.posexplode("runs").alias("pos", "run"))
    same = Window.partitionBy("run")
    shared = runs.withColumns({"one": F.min("b").over(same), "other": F.max("b").over(same)}).where("one <> other")
    islands = shared.select("b", F.col("pos") - F.row_number().over(Window.partitionBy("b").orderBy("pos"))).toDF("b", "island")
    held = islands.groupBy("b", "island").agg(F.count("*").alias("n")).groupBy("b").agg(F.max("n").alias("most"), F.sum("n").alias("n"))
    sized = bodies.select("body", F.xxhash64("body").alias("b"), F.size("runs").alias("size")).join(held.hint("merge"), "b")
    return sized.select("body", (F.col("most") > SPAN - RUN).alias("long"), (F.col("n") == F.col("size")).alias("all")).where("long OR all")


def _copied(own: DataFrame, kind: str) -> DataFrame:
    """(uid, line_no) of unmarked own lines that verify as own text of other mails found by fingerprints."""
    # mails of equal own text are as old as the first of them and stand for each other; least and most tell whether they are one key's
    since = F.min(F.struct(F.col("at").isNull(), "at", "id")).alias("since")
    first = [F.first(c).alias(c) for c in ("lines", "runs", "prints")]
    bodies = own.where(F.size("prints") > 0).groupBy("body").agg(since, F.min("id").alias("least"), F.max("id").alias("most"), *first)
    bodies = materialize(bodies)
    held = materialize(_held(bodies))
    prints = bodies.select("body", "since", F.explode("prints").alias("p")).join(held, "body", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("long", "all")})
    # every holder of a fingerprint is met, from the side of a text that may copy and from that of one that may be a part
    mine, theirs = prints.select("p", "body", "since", "long"), prints.select("p", F.col("body").alias("other"), F.col("since").alias("then"), "all")
    earlier = F.struct("then", "other") < F.struct("since", "body")
    met = mine.where("long").join(theirs.hint("merge"), "p").where((F.col("body") != F.col("other")) & earlier)
    parts = mine.join(theirs.where("all").hint("merge"), "p").where(F.col("body") != F.col("other"))
    both = met.select("body", "other", F.lit(True).alias("earlier")).union(parts.select("body", "other", earlier.alias("earlier"))).distinct()
    texts = bodies.select(F.col("body").alias("other"), F.col("lines").alias("text"), "least", "most")
    others = both.join(texts.hint("merge"), "other").groupBy("body").agg(F.collect_list(F.struct("text", "earlier", "least", "most")).alias("others"))
    # a key's own other texts are not other mails
    foreign = F.filter("others", lambda x: ~((x["least"] == F.col("id")) & (x["most"] == F.col("id"))))
    pairs = own.join(others.hint("merge"), "body").select("uid", "numbers", "lines", F.transform(foreign, lambda x: F.struct(x["text"].alias("text"), x["earlier"].alias("earlier"))).alias("others"))

    def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for uid, numbers, lines, found in zip(frame["uid"], frame["numbers"], frame["lines"], frame["others"]):
                out += [(uid, numbers[i]) for i in history(list(lines), [(list(x["text"]), x["earlier"]) for x in found])]
            yield pd.DataFrame(out, columns=["uid", "line_no"])

    return pairs.mapInPandas(verify, "uid string, line_no int")


def new_lines(df: DataFrame, key: str = "id", text: str = "compiled_truth", when: str = "created_at") -> DataFrame:
    """(key, line_no, line): the lines newly written by each mail's sender.

    ``when`` tells which of two mails is the earlier one; without such a column the smaller key is.
    """
    kind = df.schema[key].dataType.simpleString()
    at = F.date_format(F.col(when).cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS") if when in df.columns else F.lit(None).cast("string")
    mails = df.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"), at.alias("at")).where("id IS NOT NULL AND text IS NOT NULL")
    total = mails.select("id").distinct().count()
    often = max(NOTICE_LEAST, NOTICE_SHARE * total)
    # a line of a hundredth of the mails: at most a hundred times the mean number of lines a mail
    often_said = _marks(mails, kind).groupBy("mark").agg(F.countDistinct("id").alias("mails")).where(F.col("mails") >= often)
    notices = {r["mark"] for r in often_said.select("mark").collect()}
    # two differing texts of one key are two mails
    each = mails.groupBy("id", "text").agg(F.min("at").alias("at")).withColumn("uid", F.sha2(F.concat_ws("\n", F.col("id").cast("string"), "text"), 256))
    own = materialize(_own(each, kind, notices))
    lines = own.select("id", "uid", F.explode(F.arrays_zip("numbers", "lines")).alias("one")).select("id", "uid", F.col("one.numbers").alias("line_no"), F.col("one.lines").alias("line"))
    new = lines.join(_copied(own, kind), ["uid", "line_no"], "left_anti")
    return new.select(F.col("id").alias(key), "line_no", "line").distinct()
