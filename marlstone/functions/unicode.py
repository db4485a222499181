"""Normal forms of text, which the JVM's functions lack: Arrow batches of distinct work, no row-at-a-time calls."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_SEGMENT = re.compile(r"[^a-z0-9._぀-ヿ㐀-䶿一-鿿가-힯]+")


def nfkc_key(text: str) -> str:
    """Compatibility form, lower case, white space as one blank, no brackets, quotes or blanks at the ends."""
    return " ".join(unicodedata.normalize("NFKC", text).lower().split()).strip(" []{}()\"'“”‘’")


def nfkd_slug(text: str) -> str:
    """Letters and digits without marks, runs of others as one hyphen."""
    plain = "".join(c for c in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(c))
    return re.sub(r"[^a-z0-9]+", "-", plain).strip("-")


def path_slug(path: str) -> str:
    """A path's segments as slugs: dots, underscores and CJK letters stay; empty segments leave."""
    parts = ("".join(c for c in unicodedata.normalize("NFKD", p.lower()) if not unicodedata.combining(c)) for p in unicodedata.normalize("NFC", path).split("/"))
    return "/".join(s for s in (_SEGMENT.sub("-", p).strip("-") for p in parts) if s)


def _column(call):
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else call(t))

    return lambda c: run(c)


def nfkc(text: Column) -> Column:
    return _column(nfkc_key)(text)


def slug(text: Column) -> Column:
    return _column(nfkd_slug)(text)


def segments(path: Column) -> Column:
    return _column(path_slug)(path)
