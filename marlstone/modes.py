"""Settings of searches: named modes, overrides and a hash that caches go by."""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import asdict, dataclass, replace

#: The arms' weights by what a query is after: keywords, vectors, graph.
WEIGHTS = {"entity": (1.2, 0.9, 1.2), "temporal": (1.0, 1.0, 0.8), "event": (1.1, 1.0, 1.0), "general": (1.0, 1.0, 1.0)}
#: How much detail results show by what a query is after.
DETAIL = {"entity": "low", "temporal": "high", "event": "medium", "general": "medium"}


@dataclass(frozen=True)
class Settings:
    """What a search may be told; each value has a default."""

    limit: int = 20
    rrf_k: int = 60
    cosine_share: float = 0.3
    per_page: int = 2
    type_share: float = 0.6
    alike: float = 0.85
    recency: float = 1.0
    salience: float = 0.15
    floor: float | None = None
    budget: int | None = None
    rerank: bool = False

    def __post_init__(self):
        if not (1 <= self.limit <= 100 and self.rrf_k > 0 and 0 <= self.cosine_share <= 1 and 0 < self.type_share <= 1):
            raise ValueError("a setting is out of range")

    @property
    def fingerprint(self) -> str:
        """A hash that is the same for equal settings."""
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True).encode()).hexdigest()[:16]


MODES = {"quick": Settings(limit=10, cosine_share=0.0, per_page=1), "balanced": Settings(), "thorough": Settings(limit=50, rerank=True, salience=0.3, per_page=3)}


def resolved(mode: str | None = None, override: dict | None = None, call: dict | None = None) -> Settings:
    """Settings by precedence: of the call, then an override, then the mode, then the defaults. Nulls do not count."""
    if mode is not None and mode not in MODES:
        raise ValueError(f"no mode {mode}")
    out = MODES[mode] if mode else Settings()
    for layer in (override, call):
        known = {k: v for k, v in (layer or {}).items() if v is not None}
        unknown = set(known) - set(asdict(out))
        if unknown:
            raise ValueError(f"unknown settings {sorted(unknown)}")
        out = replace(out, **known)
    return out


#: Questions about relations: pattern, link type, and whether the answer is at the far end of the links.
RELATIONS = (
    (r"^who (?:founded|started) (.+?)\??$", "founded", False), (r"^what (?:companies )?did (.+?) (?:found|start)\??$", "founded", True), (r"^who invested in (.+?)\??$", "invested_in", False),
    (r"^(?:what|which companies) did (.+?) invest in\??$", "invested_in", True), (r"^who works (?:at|for) (.+?)\??$", "works_at", False), (r"^where does (.+?) work\??$", "works_at", True), (r"^who advises (.+?)\??$", "advises", False),
    (r"^who (?:attended|was at) (.+?)\??$", "attended", False), (r"^(?:how (?:is|are)|what connects) (.+?) (?:connected to|and) (.+?)\??$", None, True),
)


def relation(question: str) -> tuple[list[str], str | None, str] | None:
    """(seeds, link type, way) that a question about a relation asks for; None for other questions."""
    text = " ".join(question.split())
    for pattern, kind, out in RELATIONS:
        if found := re.match(pattern, text, re.I):
            return list(found.groups()), kind, "out" if out else "in"
    return None
