"""Personal information in free text: finding it, and replacing it by typed surrogates.

Emails, telephone numbers, personal numbers and postal addresses are found by the shapes their
issuers give them; a shape that other numbers share needs a word that announces it. Names are found
token by token: given names come from counting the first words of the titles of person pages, family
names from looking words up among those of all titles and, where they are not known there, from a
suffix classifier fitted on a bounded sample of them; ordinary words are counted over all bodies. Given
and family names combine with titles, initials, particles and inverted order. Letters of any script make
words; names in ideographs, which stand without gaps, are looked up whole among the titles.

Surrogates are keyed: digits and letters go through a keyed, format-preserving bijection without fixed
points (a Feistel network over each token's characters, a shift, and the network backwards), so equal
values get equal surrogates everywhere, different ones never collide, none equals its original, and
length, script, case, accents, separators and the ending of a name that tells gender in its language
stay. First letters have a permutation of their own, so initials stay true to the names they
abbreviate. ``audit`` counts what is left in the texts, unchanged values and collisions.

Defined results
- Null texts give no value and stay null; empty texts stay empty; long texts are processed whole.
- Overlapping finds: email, then personal number, phone, address, name; each character counts once.
- Repeated rows count once. Extra columns are not carried. Ties do not arise.
- White space inside a value may be a line break with quote marks; the value is given as it stands.
"""

from __future__ import annotations

import hashlib
import math
import re
import string
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import names

#: Family names of the sample the classifier is fitted on, and how many ordinary words.
SAMPLE_NAMES, SAMPLE_WORDS = 30_000, 30_000
#: Bodies the ordinary words are counted in, and from how many places there a word is ordinary for sure.
SAMPLE_BODIES, OFTEN = 3_000, 25
#: Log odds from which a capitalised word is a family name: standing alone, and beside a given name.
ALONE, BESIDE = 4.0, -3.0
#: The odds of a word that titles hold as a family name.
KNOWN = 20.0

# Common short forms of given names, besides those of the table given.
SHORT_FORMS = (
    "abby", "al", "alex", "andy", "ben", "benji", "bert", "beth", "bob", "bobby", "cathy", "charlie", "chris", "dan", "danny", "dave", "deb", "debbie", "dick", "ed", "eddie",
    "ellie", "fran", "fred", "freddie", "fritz", "gabi", "greg", "hal", "harry", "hettie", "izzy", "jack", "jamie", "jeff", "jim", "jimmy", "joe", "jon", "josh", "kate", "kathy",
    "katie", "ken", "kit", "larry", "len", "lenny", "liz", "lizzie", "maggie", "matt", "meg", "mick", "mike", "nell", "nick", "nicky", "olu", "pat", "peggy", "pepe", "pete", "pippa",
    "ray", "rich", "rick", "rob", "robbie", "ron", "sam", "sasha", "steve", "sue", "susie", "ted", "theo", "tim", "tom", "tommy", "tony", "tori", "trish", "uli", "val", "vicky", "wally",
    "walt", "zack", "zosia",
)

# White space inside a value: blanks, or one line end with quote marks.
_S = r"(?:[ \t]+|[ \t]*\r?\n[ \t]*(?:[>|][ \t]*)*)"
_W = r"[^\W\d_]"

_PART = r"[A-Za-z0-9_+\-]+"
_EMAIL = re.compile(
    rf"(?<![\w.+\-]){_PART}(?:(?:\.|\[dot\]|\(dot\)){_PART})*(?:@|\[at\]|\(at\))[A-Za-z0-9\-]+(?:(?:\.|\[dot\]|\(dot\))[A-Za-z0-9\-]+)*(?:\.|\[dot\]|\(dot\))[A-Za-z]{{2,}}(?![\w@])"
)
# spelled out: in "reach her at a dot b at c dot d" the first "at" joins nothing
_SPELLED = re.compile(
    rf"(?<![\w.+\-]){_PART}(?:(?:{_S}dot{_S}|\.){_PART})*{_S}at{_S}[A-Za-z0-9\-]+(?:{_S}dot{_S}[A-Za-z0-9\-]+)*{_S}dot{_S}[A-Za-z]{{2,}}(?!\w|{_S}(?:at|dot)\b|@|\[at\]|\.\w)"
)
_LINK = re.compile(r"\[\[[^\]\n]*\]\]|https?://\S+|(?<!\w)@\w+|\b(?:people|companies|projects)/[\w\-/]+")

# Numbers whose shape alone tells: dashed social security, national insurance, personnummer, DNI, CPF, tax id, licence.
_IDNUM = re.compile(
    rf"(?<![\w\-.])(?:\d{{3}}-\d\d-\d{{4}}|[A-CEGHJ-PQR-TW-Z]{{2}}(?:{_S}|)\d\d(?:{_S}|)\d\d(?:{_S}|)\d\d(?:{_S}|)[A-D]|\d{{6}}[-+]\d{{4}}|\d{{8}}[A-Z]|[XYZ]\d{{7}}[A-Z]"
    rf"|\d{{3}}\.\d{{3}}\.\d{{3}}-\d\d|\d\d{_S}\d{{3}}{_S}\d{{3}}{_S}\d{{3}}|[A-Z]\d{{3}}-\d{{4}}-\d{{4}})(?![\w\-])"
)
# Numbers that a word announces.
_TOLD = re.compile(
    rf"\b(?:social{_S}security(?:{_S}(?:number|no\.?))?|ssn|passport(?:{_S}(?:number|no\.?))?|reisepass(?:nummer)?|passeport|driving{_S}licen[cs]e|driver'?s{_S}licen[cs]e|führerschein|"
    rf"ni{_S}number|nino|national{_S}insurance(?:{_S}number)?|steuer-?id|tax{_S}id|personnummer|dni|cpf|nif|nir|national{_S}id)(?:[:#]|{_S}|{_S}is{_S}|:{_S}|{_S}no\.?:?{_S})"
    rf"(?:{_S})?([A-Z]{{0,2}}\d[\dA-Z]*(?:(?:[.\-]|{_S})\d[\dA-Z]*)*(?:{_S}[A-D]\b)?)", re.I
)

_EXT = rf"(?:{_S}?(?:x|ext\.?|extension){_S}?\d{{1,6}}\b)?"
_PHONE = re.compile(
    rf"(?<![\w\-./=#:+])(?:\+\d{{1,3}}(?:(?:{_S}|[-./])?(?:\(\d{{1,4}}\)|\d{{1,5}})){{1,6}}|00\d\d(?:(?:{_S}|[-./])\d{{1,6}}){{2,5}}|\(\d{{3}}\){_S}?\d{{3}}[-. ]\d{{4}}|\d{{3}}[-.]\d{{3}}[-.]\d{{4}}"
    rf"|\d{{3}}-\d{{4}}|0\d{{2,4}}{_S}?/{_S}?\d{{3,6}}(?:(?:{_S}|[-])\d{{2,5}})*|0\d{{2}}{_S}\d{{4}}{_S}\d{{4}}|0\d(?:{_S}\d\d){{4}}|0\d{{4}}{_S}\d{{6}}|[2-9]\d{{2}}[2-9]\d{{6}})(?![-/\d]|[.,]\d|\w){_EXT}", re.I
)

_CAP = r"[A-ZÀ-ÖØ-Þ][\wÀ-ž'’]*"
_TOWN = rf"{_CAP}(?:-{_CAP})*"
_KINDS = r"(?:Street|St\b\.?|Avenue|Ave\b\.?|Road|Rd\b\.?|Lane|Ln\b\.?|Boulevard|Blvd\b\.?|Close|Drive|Way|Court|Ct\b\.?|Place|Terrace|Square|Crescent|Gardens|Row|Mews)"
_UNIT = rf"(?:,{_S}(?:(?:Apt|Unit|Suite|Flat|Apartment)\.?{_S}\w+|\#{_S}?\w+))"
_PLACE = rf"(?:,{_S}{_TOWN}(?:,{_S}[A-Z]{{2}}{_S}\d{{5}}(?:-\d{{4}})?|{_S}[A-Z]{{1,2}}\d[\dA-Z]?{_S}\d[A-Z]{{2}})?)"
_CODED = rf"(?:,{_S}\d{{5}}{_S}{_TOWN})"
_ADDRESS = re.compile(
    rf"(?<![\w\-.])(?:(?:Flat|Apt|Unit){_S}\w+,{_S})?\d{{1,5}}[a-zA-Z]?{_S}(?:{_CAP}{_S}){{1,4}}{_KINDS}{_UNIT}?{_PLACE}?"
    rf"|(?<![\w\-.])\d{{1,5}}[a-z]?{_S}(?:[a-z][\w'’]*{_S}){{1,4}}(?:street|avenue|road|lane|close|drive|court|boulevard){_S}[a-z]+(?:-[a-z]+)*"
    rf"|(?<!\w)P\.?{_S}?O\.?{_S}Box{_S}\d+(?:,{_S}{_TOWN})?"
    rf"|(?<![\w\-.])\d{{1,4}}(?:{_S}(?:bis|ter))?,?{_S}(?:rue|avenue|boulevard|place|chemin|allée|impasse|quai){_S}(?:(?:de|du|des|la|le|les|d’|d'){_S}?)*{_CAP}(?:{_S}{_CAP})*{_CODED}?"
    rf"|(?<!\w)(?:Calle|Avenida|Plaza|Paseo|Camino|Rua){_S}(?:(?:de|del|la|las|los|da|do){_S})*{_CAP}(?:{_S}{_CAP})*,?{_S}\d{{1,4}}(?:,{_S}\d{{1,2}}\.?[ºª°][ \w]?)?{_CODED}?"
)

_STREET = re.compile(rf"(?<!\w)(?:{_CAP}[\- ])?[A-ZÀ-ÖØ-Þ][\wÀ-ž]*?(?:straße|strasse|weg|platz|gasse|allee|str\.){_S}\d{{1,4}}{_S}?[a-z]?\b{_CODED}?")
_STREETS = re.compile(r"(?:straße|strasse|weg|platz|gasse|allee|str\.)\s+\d")

_HONOR = r"(?:Dr|Prof|Professor|Mr|Mrs|Ms|Mx|Miss|Herr|Frau|Mme)"
_TOKEN = re.compile(rf"{_W}(?:[\w'’]|-(?={_W}))*")
_FIELD_AFTER = re.compile(
    rf"{_S}(?:Holdings|Systems|Media{_S}Group|Group|Associates|Manufacturing|Technologies|Software|Capital|Energy|Logistics|Robotics|Foods|Shipping|Consulting|Orchards|Brothers|Insurance|"
    rf"Biosciences|Laboratories|Labs|Foundation|International|Analytics|Engineering|Pharmaceuticals|Inc|GmbH|Ltd|LLC|SA|Corporation|Corp|Company)\b"
)


def _plain(token: str) -> str:
    return names.plain(token).replace("'", "").replace("’", "")


class Suffixes:
    """Naive Bayes over the beginnings and endings of words: family names against ordinary capitalised words."""

    SIZES = (2, 3, 4, 5)

    def __init__(self, positive: list[str], negative: list[str]):
        # hashes, ascending, of the family names and the ordinary words whose odds alone would mislead
        self.known = self.ordinary = np.zeros(0, dtype=np.int64)
        self.weights: dict[str, float] = {}
        counts = [self._count(positive), self._count(negative)]
        sizes = [max(len(positive), 1), max(len(negative), 1)]
        for feature in counts[0].keys() | counts[1].keys():
            p, n = ((c.get(feature, 0) + 0.5) / (s + 1) for c, s in zip(counts, sizes))
            self.weights[feature] = math.log(p / n)
        self.seen: dict[str, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"seen": {}}

    def _features(self, word: str) -> list[str]:
        return [f"${word[-k:]}" for k in self.SIZES if len(word) >= k] + [f"^{word[:2]}", f"#{min(len(word), 14)}"]

    def _count(self, found: list[str]) -> dict[str, int]:
        out: dict[str, int] = {}
        for word in found:
            for feature in self._features(word):
                out[feature] = out.get(feature, 0) + 1
        return out

    def odds(self, word: str) -> float:
        """Log odds that a plain word is a family name, by its shape alone."""
        found = self._features(word)
        # longer endings contain shorter ones: count the longest that was seen, and half of the rest
        ends = [self.weights[f] for f in reversed(found[:-2]) if f in self.weights]
        return (ends[0] if ends else -1.0) + sum(self.weights.get(f, 0.0) for f in found[-2:]) * 0.5

    def score(self, word: str) -> float:
        """Log odds that a plain word is a family name."""
        if word not in self.seen:
            if len(self.seen) > 300_000:  # memory only
                self.seen.clear()
            mark = _word_hash(word)
            self.seen[word] = KNOWN if _holds(self.known, mark) else -99.0 if _holds(self.ordinary, mark) else self.odds(word)
        return self.seen[word]


def _word_hash(word: str) -> int:
    value = xxhash.xxh64_intdigest(word)
    return value - (1 << 64) if value >> 63 else value


def _holds(ascending: np.ndarray, value: int) -> bool:
    at = int(np.searchsorted(ascending, value))
    return at < len(ascending) and int(ascending[at]) == value


class Finder:
    """All kinds of personal information in a text."""

    def __init__(self, given: set[str], families: Suffixes, whole: np.ndarray | None = None):
        self.given, self.families = given, families
        # hashes, ascending, of names in scripts without gaps, which only titles tell
        self.whole = np.zeros(0, dtype=np.int64) if whole is None else whole
        self.seen: dict[str, tuple[str, bool, float, bool]] = {}

    def __getstate__(self):
        return self.__dict__ | {"seen": {}}

    def find(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, kind), in order and disjoint."""
        out: list[tuple[int, int, str]] = []
        masked = text

        def take(spans: list[tuple[int, int]], kind: str | None) -> None:
            nonlocal masked
            if not spans:
                return
            parts, at = [], 0
            for a, z in spans:
                if a < at:
                    continue
                parts += [masked[at:a], "\x00" * (z - a)]
                at = z
                if kind:
                    out.append((a, z, kind))
            masked = "".join(parts) + masked[at:]

        if "@" in text or "at]" in text or "at)" in text:
            take([m.span() for m in _EMAIL.finditer(masked)], "email")
        if _DOTTED.search(text):
            take([m.span() for m in _SPELLED.finditer(masked)], "email")
        if "[[" in text or "/" in text or "@" in text:
            take([m.span() for m in _LINK.finditer(masked)], None)
        if _DIGITS.search(masked):
            told = [m.span(1) for m in _TOLD.finditer(masked) if sum(c.isdigit() for c in m[1]) >= 6]
            take(told, "idnum")
            take([m.span() for m in _IDNUM.finditer(masked)], "idnum")
            take([(m.start(), m.start() + len(_trim(m[0]))) for m in _PHONE.finditer(masked)], "phone")
            take([m.span() for m in _ADDRESS.finditer(masked)], "address")
            if _STREETS.search(masked):
                take([m.span() for m in _STREET.finditer(masked)], "address")
        out += [(a, z, "name") for a, z in self.names(masked)]
        if len(self.whole) and not masked.isascii():
            out += [(a, z, "name") for a, z in self.unspaced(masked)]
        return sorted(out)

    def unspaced(self, text: str) -> list[tuple[int, int]]:
        """Names of person titles in ideographs, the longest at each place."""
        out = []
        for run in _IDEOGRAPHS.finditer(text):
            i, end = run.span()
            while i < end - 1:
                z = next((z for z in range(min(end, i + 4), i + 1, -1) if _holds(self.whole, _word_hash(text[i:z]))), 0)
                if z:
                    out.append((i, z))
                i = z or i + 1
        return out

    def _info(self, token: str) -> tuple[str, bool, float, bool]:
        """(plain form, given name, log odds of a family name, may begin a name), remembered."""
        found = self.seen.get(token)
        if found is None:
            if len(self.seen) > 400_000:  # memory only
                self.seen.clear()
            plain = _plain(token)
            given = plain in self.given and len(plain) > 1
            base = plain.removeprefix("al-")
            odds = self.families.score(base) if len(base) >= 2 and not _DIGITS.search(token) else -99.0
            if len(base) < 4 and odds not in (KNOWN, -99.0):  # too short for a shape: a name only beside a title, an initial or a given name
                odds = 0.5 if token[0].isupper() and token[1:].islower() else -99.0
            upper = token[0].isupper() or token.startswith("al-")
            may = given or (upper and (odds >= 0 or len(token) == 1)) or plain in names.PARTICLES
            found = self.seen[token] = (plain, given, odds, may)
        return found

    def names(self, text: str) -> list[tuple[int, int]]:
        tokens = [(m.start(), m.end(), m[0]) for m in _TOKEN.finditer(text)]
        n = len(tokens)
        info = [self._info(t) for _, _, t in tokens]
        out: list[tuple[int, int]] = []

        def gap(i: int) -> str:
            return text[tokens[i][1] : tokens[i + 1][0]] if i + 1 < n else "\x00"

        def blank(i: int) -> bool:
            return bool(_BLANK.fullmatch(gap(i)))

        def initial(i: int) -> bool:
            return len(tokens[i][2]) == 1 and tokens[i][2].isupper() and text[tokens[i][1] : tokens[i][1] + 1] == "."

        def after_initial(i: int) -> bool:
            """A blank follows the dot of the initial i."""
            return i + 1 < n and gap(i)[:1] == "." and bool(_BLANK.fullmatch(gap(i)[1:]))

        def family(i: int, least: float, small: bool = False) -> int:
            """The index after a family name with its particles at i, or i; ``small`` allows lower case."""
            j = i
            while j < n and info[j][0] in names.PARTICLES and j - i < 3 and blank(j):
                j += 1
            if j >= n:
                return i
            word = tokens[j][2]
            plain, is_given, odds, _ = info[j]
            if len(plain) < 2 or not (word[0].isupper() or j > i or small or least <= BESIDE or word.startswith("al-")):
                return i
            if is_given and least > BESIDE:
                return i
            if odds < (least if word[0].isupper() or word.startswith("al-") else max(least, 2.0)):
                return i
            return j + 1

        def end_of(i: int) -> int:
            z = tokens[i][1]
            for tail in ("'s", "’s", "'", "’"):
                if text[:z].endswith(tail):
                    return z - len(tail)
            return z

        i = 0
        while i < n:
            if not info[i][3]:
                i += 1
                continue
            a, z, word = tokens[i]
            titled = i > 0 and _TITLED.match(text, tokens[i - 1][0]) is not None and tokens[i - 1][2] in _HONORS and _AFTER_TITLE.fullmatch(gap(i - 1)) is not None
            lower = word[0].islower()
            is_given = info[i][1]
            # Given [I.] Family, Given Family, Given I.
            if is_given and (not lower or (i + 1 < n and blank(i))):
                j, last = i + 1, i
                if blank(i) and j < n and initial(j):
                    if after_initial(j):
                        k = family(j + 1, BESIDE if not lower and "\n" not in gap(j) else 2.0, lower)
                        if k > j + 1:
                            out.append((a, end_of(k - 1)))
                            i = k
                            continue
                    if not lower:
                        j += 1
                elif blank(i):
                    k = family(j, BESIDE if not lower and "\n" not in gap(i) else 2.0, lower)
                    if k > j and not info[k - 1][1]:
                        out.append((a, end_of(k - 1)))
                        i = k
                        continue
                if not lower and not _FIELD_AFTER.match(text, z):
                    out.append((a, end_of(i)))
                    i += 1
                    continue
                if lower and not self._greets(text, a, z):
                    i += 1
                    continue
            if lower and is_given and self._greets(text, a, z):
                out.append((a, z))
                i += 1
                continue
            # I. [I.] Family
            if initial(i) and after_initial(i):
                j = i + 1
                if j < n and initial(j) and after_initial(j):
                    j += 1
                k = family(j, 0.0)
                if k > j:
                    out.append((a, end_of(k - 1)))
                    i = k
                    continue
            # Family, Given; Family I.; Family
            k = family(i, 0.0 if titled else ALONE)
            if k > i and not _FIELD_AFTER.match(text, tokens[k - 1][1]):
                stop, upto = end_of(k - 1), k
                if k < n and _COMMA.fullmatch(gap(k - 1)) and info[k][1] and not tokens[k][2][0].islower() and not (
                    blank(k) and family(k + 1, ALONE) > k + 1
                ):
                    stop, upto = end_of(k), k + 1
                    if blank(k) and upto < n and initial(upto):
                        stop, upto = tokens[upto][1] + 1, upto + 1
                elif k < n and blank(k - 1) and info[k][1] and tokens[k][2][0].isupper() and word[0].isupper() and not (blank(k) and family(k + 1, ALONE) > k + 1):
                    stop, upto = end_of(k), k + 1
                elif k < n and _COMMA.fullmatch(gap(k - 1)) and initial(k) and not (after_initial(k) and family(k + 1, ALONE) > k + 1):
                    stop, upto = tokens[k][1] + 1, k + 1
                out.append((a, stop))
                i = upto
                continue
            i += 1
        return out

    @staticmethod
    def _greets(text: str, a: int, z: int) -> bool:
        """Whether a lower-case given name stands as one: behind a greeting or closing, or alone on its line."""
        begin = text.rfind("\n", 0, a) + 1
        end = text.find("\n", z)
        line = text[begin : end if end >= 0 else len(text)]
        return bool(_GREETING.match(line)) and len(line) < 60


_DIGITS = re.compile(r"\d")
_DOTTED = re.compile(r"\sdot\s")
#: Fixed value: digits of a whole number by country code.
_LENGTHS = {"1": 11, "33": 11, "44": 12, "34": 11, "351": 12, "55": 13}


def _trim(found: str) -> str:
    """An international number without digits of the text behind it."""
    if found[0] != "+":
        return found
    digits = re.sub(r"\D", "", found)
    whole = next((n for code, n in _LENGTHS.items() if digits.startswith(code)), None)
    if whole is None:  # of no fixed length: it ends with its line
        return found.split("\n")[0].rstrip() if sum(c.isdigit() for c in found.split("\n")[0]) >= 10 else found
    whole += "(0)" in found
    seen = 0
    for i, c in enumerate(found):
        seen += c.isdigit()
        if seen == whole:
            rest = found[i + 1 :]
            return found if re.fullmatch(_EXT, rest, re.I) else found[: i + 1]
    return found


_BLANK = re.compile(_S)
#: A run of ideographs, and a title that is a name of two to four of them.
_IDEOGRAPHS = re.compile(r"[\u4e00-\u9fff]{2,}")
UNSPACED = r"^[\u4e00-\u9fff]{2,4}$"
_COMMA = re.compile(rf",{_S}")
_HONORS = {"Dr", "Prof", "Professor", "Mr", "Mrs", "Ms", "Mx", "Miss", "Herr", "Frau", "Mme"}
_TITLED = re.compile(rf"{_HONOR}\b")
_AFTER_TITLE = re.compile(rf"\.?{_S}")
_GREETING = re.compile(
    r"[>|\s]*(?:(?:hi|hello|hey|dear|hallo|hola|bonjour|liebe[r]?|best|cheers|thanks|many thanks|kind regards|regards|talk soon|saludos|cordialement|viele grüße|br)[,!]?\s+)?"
    r"[a-zà-ž'’\-]+(?:\s+[a-zà-ž'’\-]+)?\s*[,!\-]?\s*$", re.I
)


def finder(pages: DataFrame, shorts: DataFrame, texts: DataFrame | None = None) -> Finder:
    """A finder fitted on the titles of person pages.

    Given names are first words of a fixed share of all titles (counted over all of them); the
    classifier is fitted on at most SAMPLE_NAMES family names, chosen by hash, and SAMPLE_WORDS
    ordinary capitalised words of the pages' bodies. Its weights alone come from samples: the family
    names of all titles and the ordinary words of all bodies are known. Of them only those come to the
    driver whose odds would say otherwise, as hashes of 8 bytes.
    """
    people = pages.where("type = 'person'").select(F.col("id"), F.col("title"), F.col("slug")).distinct()
    table = names.short_forms(shorts)
    common = names._common(people, "person", table)
    given = set(common.known) | set(common.short) | {names.plain(x) for pair in table for x in pair} | set(SHORT_FORMS)

    def last_words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for title, slug in zip(frame["title"], frame["slug"]):
                found, tail, comma, _ = names.parts(title, slug, "person")
                reading = common.reading(found, comma) or common.reading(tail, False)
                if reading:
                    own = next((w for w in (found if found else tail) if reading[1].endswith(_plain(w).strip(".")) and len(w) > 1), None)
                    if own and (word := _plain(own).strip(".")) and word not in given:
                        out.append(word)
            yield pd.DataFrame({"word": out}, dtype=object)

    last = materialize(people.mapInPandas(last_words, "word string").distinct())
    family = sorted(r["word"] for r in _sampled(last.where("length(word) > 3"), "word", SAMPLE_NAMES).collect())
    # ordinary words: capitalised words of a bounded sample of bodies that do not follow given names
    whole = pages.where("compiled_truth IS NOT NULL").select("id", F.col("compiled_truth").alias("t"))
    bodies = _sampled(whole, "id", SAMPLE_BODIES)

    def capitals(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shapes: dict[str, tuple[str, bool]] = {}
        for frame in frames:
            n, named = Counter(), Counter()
            for text in frame["t"]:
                before = False
                for token in _TOKEN.findall(text):
                    found = shapes.get(token)
                    if found is None:
                        if len(shapes) > 400_000:  # memory only
                            shapes.clear()
                        word = _plain(token)
                        found = shapes[token] = (word, word in given or len(word) == 1 or word in names.HONORIFICS or word in names.PARTICLES)
                    if len(token) > 1 and token[0].isupper():
                        n[found[0]] += 1
                        named[found[0]] += before
                    before = found[1]
            yield pd.DataFrame({"word": list(n), "n": list(n.values()), "named": [int(named[w]) for w in n]}).astype({"word": object, "n": int, "named": int})

    def count(df: DataFrame) -> DataFrame:
        return df.select("t").mapInPandas(capitals, "word string, n bigint, named bigint").groupBy("word").agg(F.sum("n").alias("n"), F.sum("named").alias("named"))

    counted = count(bodies)
    seldom_named = "named <= 0.05 * n OR (named <= 1 AND n > 2)"
    plain = counted.where(seldom_named).where("length(word) > 3").orderBy(F.desc("n"), "word").limit(SAMPLE_WORDS).collect()
    known, endings = set(family), {f[-5:] for f in family}
    # a seldom word that is or ends like a family name may be one: it is no example of an ordinary word
    ordinary = {r["word"] for r in plain if r["word"] not in given and (r["n"] >= OFTEN or (r["word"] not in known and r["word"][-5:] not in endings))}
    families = Suffixes([f for f in family if f not in ordinary], sorted(ordinary))

    # the same rule over all titles and bodies; words come to the driver where the odds alone would decide otherwise
    ends = last.select(F.substring("word", -5, 5).alias("ending"), F.lit(True).alias("like")).distinct()
    told = count(whole).where(seldom_named).select("word", "n", F.substring("word", -5, 5).alias("ending"))
    told = told.join(ends.hint("merge"), "ending", "left").select("word", F.when((F.col("n") >= OFTEN) | F.col("like").isNull(), True).alias("plain"))
    words = told.where("plain").join(last.withColumn("family", F.lit(True)).hint("merge"), "word", "full")

    def misjudged(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for word, plain in zip(frame["word"], frame["plain"].notna()):
                if word not in given and (families.odds(word) >= BESIDE if plain else families.odds(word) < ALONE):
                    out.append((_word_hash(word), bool(plain)))
            yield pd.DataFrame(out, columns=["mark", "plain"])

    unspaced = people.where(F.col("title").rlike(UNSPACED)).select(F.col("title").alias("word")).distinct()

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"mark": [_word_hash(w) for w in frame["word"]]}, dtype="int64")

    whole = np.sort(unspaced.mapInPandas(hashed, "mark bigint").toPandas()["mark"].to_numpy(dtype=np.int64))
    marks = words.select("word", "plain").mapInPandas(misjudged, "mark bigint, plain boolean").toPandas()
    plain = marks["plain"].astype(bool)
    families.known, families.ordinary = (np.sort(marks["mark"][which].to_numpy(dtype=np.int64)) for which in (~plain, plain))
    return Finder(given, families, whole)


def _sampled(df: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` rows, chosen on the scan by the hash of their key; all rows where there are no more."""
    step = max(1, math.ceil(df.select(key).count() / (0.8 * most)))
    return df.where(F.pmod(F.xxhash64(key), F.lit(step)) == 0).limit(most)


def found(texts: DataFrame, fit: Finder, key: str = "row_id") -> DataFrame:
    """(field, key, kind, value) of a table (field, key, text)."""
    kind = texts.schema[key].dataType.simpleString()

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for field, row, text in zip(frame["field"], frame[key], frame["text"]):
                if text:
                    out += {(field, row, k, text[a:z]) for a, z, k in fit.find(text)}
            yield pd.DataFrame(out, columns=["field", key, "kind", "value"])

    return texts.select("field", key, "text").mapInPandas(scan, f"field string, {key} {kind}, kind string, value string")


# --- surrogates -----------------------------------------------------------------------------------

# The letters that may stand for each other, by script.
ALPHABETS = ("aeiou", "bcdfghjklmnpqrstvwxyz", string.digits, "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ", "αεηιουω", "βγδζθκλμνξπρστφχψ", "אבגדהוזחטיכלמנסעפצקרשת", "ابتثجحخدذرزسشصضطظعغفقكلمنهوي")


class _Block:
    """A run of code points as an alphabet."""

    def __init__(self, first: int, last: int):
        self.first, self.last = first, last

    def __len__(self) -> int:
        return self.last - self.first + 1

    def __getitem__(self, i: int) -> str:
        return chr(self.first + i)

    def index(self, c: str) -> int:
        return ord(c) - self.first


#: Ideographs, hiragana, katakana, and the initial consonants of Korean syllables.
_BLOCKS = (_Block(0x4E00, 0x9FA5), _Block(0x3042, 0x3093), _Block(0x30A2, 0x30F3), _Block(0x1100, 0x1112))
_CLASS = {c: group for group in ALPHABETS for c in group}
# Endings that tell gender, longest first.
GENDERED = ("dottir", "ovna", "evna", "skaya", "ska", "ski", "sky", "ova", "eva", "ina", "son", "овна", "евна", "ович", "евич", "ская", "ский", "ова", "ева", "ина", "ов", "ев", "ин", "poulou", "poulos", "ou")


def _class(c: str) -> str | _Block | None:
    found = _CLASS.get(c)
    return found if found is not None else next((b for b in _BLOCKS if b.first <= ord(c) <= b.last), None)


_LETTERS, _RUN = re.compile(r"[^\W\d_]+"), re.compile(r"[^\W_]+")
#: Words of an address that stay.
_ADDRESS_WORDS = re.compile(rf"(?:{_KINDS}|Flat|Apt|Unit|Suite|P|O|Box|Calle|rue|bis|ter|straße|weg|road|street|lane|close)$", re.I)


class Surrogates:
    """Keyed, format-preserving replacements, distinct and never their originals."""

    def __init__(self, key: bytes, rounds: int = 4):
        self.key, self.rounds = key[:64], rounds
        self.seen: dict[tuple[str, str], str] = {}
        self.tokens: dict[tuple[str, bool], str] = {}

    def _number(self, text: str) -> int:
        return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8, key=self.key).digest(), "big")

    def _numbers(self, text: str, count: int) -> list[int]:
        """``count`` keyed numbers below 2**32, of one digest for each sixteen."""
        digest = b"".join(hashlib.blake2b(f"{text}|{part}".encode(), key=self.key).digest() for part in range(-(-count // 16)))
        return [int.from_bytes(digest[4 * i : 4 * i + 4], "big") for i in range(count)]

    def _shift(self, c: str, what: str) -> str:
        """The letter of the same alphabet a keyed distance away, never itself."""
        group = _class(c)
        return group[(group.index(c) + 1 + self._number(f"{what}|{group[0]}") % (len(group) - 1)) % len(group)]

    def _network(self, base: list[str], places: list[int], tweak: str, way: int = 1) -> None:
        """Feistel rounds in place over the characters at ``places``: one half moves by a keyed amount of the other; ``way`` -1 undoes it."""
        halves = places[::2], places[1::2]
        if not halves[1]:
            return
        for r in range(self.rounds)[::way]:
            moved, other = halves[r % 2], halves[1 - r % 2]
            seen = "".join(base[p] for p in other)
            for p, amount in zip(moved, self._numbers(f"{tweak}|{r}|{seen}", len(moved))):
                group = _class(base[p])
                base[p] = group[(group.index(base[p]) + way * amount) % len(group)]

    def token(self, token: str, name: bool = False) -> str:
        """One run of letters or digits, remembered. In a name the first letter follows its own permutation, and an ending that tells gender stays."""
        found = self.tokens.get((token, name))
        if found is None:
            if len(self.tokens) > 300_000:  # memory only
                self.tokens.clear()
            found = self.tokens[token, name] = self._token(token, name)
        return found

    def _token(self, token: str, name: bool) -> str:
        marks = [unicodedata.normalize("NFD", c) for c in token]
        base = [m[0].lower() for m in marks]
        places = [i for i, c in enumerate(base) if _class(c) is not None]
        if not places:  # a script without an alphabet here: a word of the keyed hash
            return "".join(string.ascii_lowercase[self._number(f"word|{token}") // 26**i % 26] for i in range(12)) if token.isalpha() else token
        if name:
            kept = self._ending(base, places)
            inner = [p for p in places[1:] if p < len(base) - kept]
            self._network(base, inner, f"name|{len(base)}|{base[places[0]]}|{''.join(base[len(base) - kept :])}")
            base[places[0]] = self._shift(base[places[0]], "first")
        else:
            tweak = f"text|{len(base)}"
            self._network(base, places, tweak)
            base[places[0]] = self._shift(base[places[0]], tweak)
            self._network(base, places, tweak, -1)
        at = set(places)
        return "".join(unicodedata.normalize("NFC", (b.upper() if m[0].isupper() else b) + m[1:]) if i in at else t for i, (b, m, t) in enumerate(zip(base, marks, token)))

    @staticmethod
    def _ending(base: list[str], places: list[int]) -> int:
        """The number of last characters that stay: a gendered ending behind two letters at least, else the last letter of an alphabet."""
        text = "".join(base)
        for ending in GENDERED:
            if text.endswith(ending) and len(text) >= len(ending) + 3:
                return len(ending)
        return int(len(places) > 2 and base[-1] in _CLASS)

    def value(self, kind: str, value: str) -> str:
        """The surrogate of a value: same kind, script, case, separators and lengths."""
        found = self.seen.get((kind, value))
        if found is None:
            if len(self.seen) > 200_000:  # memory only
                self.seen.clear()
            found = self.seen[kind, value] = self._value(kind, value)
        return found

    def _value(self, kind: str, value: str) -> str:
        if kind == "name":
            return _LETTERS.sub(lambda m: m[0] if m[0] in names.PARTICLES else self._named(m[0]), value)
        if kind == "email":
            local, at, host = re.match(r"(.*?)(@|\[at\]|\(at\)|\s+at\s+)(.*)", value, re.S).groups()
            cut = max(host.rfind("."), host.rfind("]"), host.rfind(" "))
            swap = lambda part: re.sub(r"\b(?!dot\b)[^\W_]+", lambda m: self.token(m[0]), part)
            return swap(local) + at + swap(host[: cut + 1]) + host[cut + 1 :]
        if kind == "address":
            return _RUN.sub(lambda m: m[0] if _ADDRESS_WORDS.match(m[0]) else self.token(m[0]), value)
        return _RUN.sub(lambda m: self.token(m[0]) if any(c.isdigit() for c in m[0]) else m[0], value)

    def _named(self, word: str) -> str:
        """The surrogate of a word of a name; what would read as a particle goes on to the next, so particles stay theirs."""
        new = self.token(word, True)
        while new in names.PARTICLES:
            new = self.token(new, True)
        return new


def redacted(texts: DataFrame, fit: Finder, secret: str, key: str = "row_id", typed: bool = True) -> DataFrame:
    """(field, key, text): every text with its values replaced.

    ``typed`` writes the kind with the surrogate, as in [name Tubita Foravend]; otherwise the bare
    surrogate stands in the text. ``secret`` keys the surrogates.
    """
    kind = texts.schema[key].dataType.simpleString()

    def rewrite(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        replace = Surrogates(secret.encode())
        for frame in frames:
            out = []
            for text in frame["text"]:
                if text:
                    parts, at = [], 0
                    for a, z, k in fit.find(text):
                        new = replace.value(k, text[a:z])
                        parts += [text[at:a], f"[{k} {new}]" if typed else new]
                        at = z
                    text = "".join(parts) + text[at:]
                out.append(text)
            yield frame.assign(text=pd.Series(out, index=frame.index, dtype=object))

    return texts.select("field", key, "text").mapInPandas(rewrite, f"field string, {key} {kind}, text string")


def audit(texts: DataFrame, fit: Finder, secret: str, key: str = "row_id") -> DataFrame:
    """(field, texts, leaked, unchanged, collisions): what redaction leaves, which must be nothing.

    leaked: texts in whose redacted form a value of theirs still stands (of names, those of two words
    or more: a lone word can stand elsewhere as no name). unchanged: values that are their own
    surrogates. collisions: surrogates that two different values of a kind share.
    """
    kind = texts.schema[key].dataType.simpleString()

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        replace = Surrogates(secret.encode())
        for frame in frames:
            rows, sent = [], set()
            for field, row, text in zip(frame["field"], frame[key], frame["text"]):
                spans, parts, at = fit.find(text) if text else [], [], 0
                for a, z, k in spans:
                    new = replace.value(k, text[a:z])
                    parts += [text[at:a], f"[{k} {new}]"]
                    at = z
                    sent.add((field, k, text[a:z], new))
                left = "".join(parts) + (text or "")[at:]
                told = {text[a:z] for a, z, k in spans if k != "name" or len(text[a:z].split()) > 1}
                rows.append((field, row, None, None, None, any(re.search(rf"(?<!\w){re.escape(v)}(?!\w)", left) for v in told if v in left)))
            rows += [(field, None, k, old, new, False) for field, k, old, new in sent]
            yield pd.DataFrame(rows, columns=["field", key, "kind", "old", "new", "leak"]).astype({key: "object"})

    seen = materialize(texts.select("field", key, "text").mapInPandas(scan, f"field string, {key} {kind}, kind string, old string, new string, leak boolean"))
    whole = seen.where("kind IS NULL").groupBy("field", key).agg(F.max("leak").alias("leak")).groupBy("field").agg(F.count("*").alias("texts"), F.count_if("leak").alias("leaked"))
    values = seen.where("kind IS NOT NULL").groupBy("field", "kind", "old", "new").agg(F.lit(1).alias("one"))
    shared = values.groupBy("field", "kind", "new").agg(F.count("*").alias("olds"), F.count_if(F.col("old") == F.col("new")).alias("same"))
    counts = shared.groupBy("field").agg(F.sum("same").alias("unchanged"), F.count_if(F.col("olds") > 1).alias("collisions"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return whole.join(counts, "field", "left").select("field", "texts", "leaked", zero("unchanged"), zero("collisions"))
