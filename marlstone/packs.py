"""Schema packs: page types, their aliases and prefixes, link rules and domains, as configuration.

A pack is read from JSON, checked, and turned into small DataFrames or column expressions; data decide
nothing about it. Packs are bounded: ``MOST`` entries of a kind at most, so what is made of them can be
shipped with a plan.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MOST = 1_000


@dataclass(frozen=True)
class PageType:
    """A type with the prefixes its pages stand under, and other names for it (with a front matter field that tells them apart)."""

    name: str
    prefixes: tuple[str, ...] = ()
    aliases: tuple[str, ...] = ()
    field: str | None = None


@dataclass(frozen=True)
class LinkRule:
    """A link type by words around a link, for pages of some type or any."""

    link_type: str
    pattern: str
    page_type: str | None = None


@dataclass(frozen=True)
class Pack:
    """A schema pack."""

    name: str
    types: tuple[PageType, ...] = ()
    links: tuple[LinkRule, ...] = ()
    domains: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        names = [n for t in self.types for n in (t.name, *t.aliases)]
        if len(set(names)) != len(names):
            raise ValueError("a name stands for two types")
        if max(len(names), len(self.links), len(self.domains)) > MOST:
            raise ValueError(f"more than {MOST} entries")
        for rule in self.links:
            re.compile(rule.pattern)

    @property
    def fingerprint(self) -> str:
        """A hash of the content, the same for equal packs."""
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True).encode()).hexdigest()[:16]

    def type_of(self, slug: Column) -> Column:
        """The type of the longest prefix that a slug has, null without one."""
        out = F.lit(None).cast("string")
        for prefix, name in sorted(((p, t.name) for t in self.types for p in t.prefixes), key=lambda x: len(x[0])):
            out = F.when(slug.startswith(prefix), F.lit(name)).otherwise(out)
        return out

    def canonical(self, kind: Column) -> Column:
        """A type's own name for any of its names; others stay."""
        out = kind
        for t in self.types:
            for alias in t.aliases:
                out = F.when(kind == alias, F.lit(t.name)).otherwise(out)
        return out

    def closure(self, spark: SparkSession) -> DataFrame:
        """(asked, type, field, value): what pages a type name means: those of the type, or of its canonical type with the alias in a field."""
        rows = [(t.name, t.name, None, None) for t in self.types]
        rows += [(a, a, None, None) for t in self.types for a in t.aliases]
        rows += [(a, t.name, t.field, a) for t in self.types if t.field for a in t.aliases]
        return spark.createDataFrame(rows, "asked string, type string, field string, value string")

    def of_type(self, asked: str, kind: Column, front: Column) -> Column:
        """Whether a page is of a type asked for by any of its names."""
        out = kind == asked
        for t in self.types:
            if asked in t.aliases and t.field:
                out = out | ((kind == t.name) & (F.get_json_object(front, f"$.{t.field}") == asked))
        return F.coalesce(out, F.lit(False))

    def link_type(self, context: Column, kind: Column) -> Column:
        """The type that the first rule tells for a link, null for none."""
        out = F.when(F.lit(False), "")
        for rule in self.links:
            hit = F.lower(context).rlike(rule.pattern)
            out = out.when(hit & (kind == rule.page_type) if rule.page_type else hit, rule.link_type)
        return out

    def domain_of(self, text: Column) -> Column:
        """The first domain whose hint stands in a text."""
        out = F.when(F.lit(False), "")
        for name, hint in self.domains.items():
            out = out.when(F.lower(text).contains(hint.lower()), name)
        return out

    def changed(self, **parts) -> Pack:
        """The pack with some parts replaced, checked again."""
        return Pack(**({"name": self.name, "types": self.types, "links": self.links, "domains": self.domains} | parts))


def load(text: str) -> Pack:
    """A pack from JSON; unknown keys are refused."""
    raw = json.loads(text)
    types = tuple(PageType(t["name"], tuple(t.get("prefixes", ())), tuple(t.get("aliases", ())), t.get("field")) for t in raw.get("types", ()))
    links = tuple(LinkRule(r["link_type"], r["pattern"], r.get("page_type")) for r in raw.get("links", ()))
    unknown = set(raw) - {"name", "types", "links", "domains"}
    if unknown:
        raise ValueError(f"unknown keys {sorted(unknown)}")
    return Pack(raw["name"], types, links, dict(raw.get("domains", {})))


#: The pack that is used where none is given.
DEFAULT = Pack(
    "base",
    (
        PageType("person", ("people/",), ("contact", "individual"), "role"), PageType("company", ("companies/",), ("organisation",), "kind"), PageType("meeting", ("meetings/",)), PageType("note", ("notes/", "inbox/"), ("memo",), "kind"),
        PageType("concept", ("concepts/",)), PageType("project", ("projects/",)), PageType("email", ("emails/",)), PageType("code", ("code/",)),
    ),
    (LinkRule("founded", r"\bfounded\b"), LinkRule("invested_in", r"\binvested in\b"), LinkRule("attended", r"\b(met|attended|joined)\b", "meeting"), LinkRule("advises", r"\badvis")),
    {"market": "market", "team": "team", "product": "product"},
)
