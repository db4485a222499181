"""Column expressions for scores, decays and intervals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def age_days(at: Column, now: str) -> Column:
    """Days from ``at`` to the fixed moment ``now``."""
    return (F.unix_micros(F.to_timestamp(F.lit(now)).cast("timestamp")) - F.unix_micros(at.cast("timestamp"))) / 86_400_000_000


def hyperbolic(age: Column, half_life: float, weight: float = 1.0) -> Column:
    """weight * h / (h + age); nothing ages below zero."""
    return F.lit(weight) * half_life / (half_life + F.greatest(age, F.lit(0.0)))


def backlink_boost(links: Column, k: float = 0.05) -> Column:
    return 1 + F.lit(k) * F.log(1 + links.cast("double"))


def reciprocal_rank(rank: Column, k: int = 60) -> Column:
    """1 / (k + rank) of a rank counted from 0; null ranks count nothing."""
    return F.coalesce(1 / (F.lit(float(k)) + rank), F.lit(0.0))


def wilson(hits: Column, n: Column, z: float = 1.959963984540054) -> tuple[Column, Column]:
    """Lower and upper end of the Wilson interval; (0, 1) without observations."""
    p, m = hits / n, n.cast("double")
    centre, spread = p + z * z / (2 * m), z * F.sqrt(p * (1 - p) / m + z * z / (4 * m * m))
    low, high = (centre - spread) / (1 + z * z / m), (centre + spread) / (1 + z * z / m)
    return F.when(n == 0, F.lit(0.0)).otherwise(F.greatest(low, F.lit(0.0))), F.when(n == 0, F.lit(1.0)).otherwise(F.least(high, F.lit(1.0)))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays; 0 if either is all zero, null unless both have one length."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(F.size(a) == F.size(b), F.when(norm == 0, F.lit(0.0)).otherwise(dot(a, b) / norm))
