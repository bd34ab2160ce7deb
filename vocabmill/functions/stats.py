"""Statistics as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Interval width, thresholds of the tiers, least sample.
Z, TIER_1, TIER_2, LEAST = 1.96, 0.99, 0.80, 30


def wilson(k: Column, n: Column, z: float = Z) -> tuple[Column, Column]:
    """Lower and upper bound of a proportion, within [0, 1]; both 0 for an empty sample."""
    p, zz = k / n, z * z
    middle, width = p + zz / (2 * n), z * F.sqrt(p * (1 - p) / n + zz / (4 * n * n))
    scale = 1 + zz / n
    bound = lambda x: F.when(n == 0, 0.0).otherwise(x)
    return bound(F.greatest(F.lit(0.0), (middle - width) / scale)), bound(F.least(F.lit(1.0), (middle + width) / scale))


def tier(low: Column, n: Column) -> Column:
    return F.when(n < LEAST, "ungraded").when(low >= TIER_1, "1").when(low >= TIER_2, "2").otherwise("inadmissible")


def earned_tier(source_class: Column, low: Column, n: Column) -> Column:
    """Authored sources are tier 3 whatever they score."""
    return F.when(source_class == "authored", "3").otherwise(tier(low, n))


def weakest(tiers: Column) -> Column:
    """The last of an array of tiers in the order of trust."""
    order = F.array(*map(F.lit, ("1", "2", "inadmissible", "ungraded")))
    return F.element_at(order, F.array_max(F.transform(tiers, lambda t: F.array_position(order, t))).cast("int"))


def match_weight(true_match: Column, true_total: Column, chance_match: Column, chance_total: Column, matched: Column, alpha: float = 0.5) -> Column:
    """Log likelihood ratio of a field that agrees or not, with a Jeffreys prior on both rates."""
    m, u = (true_match + alpha) / (true_total + 2 * alpha), (chance_match + alpha) / (chance_total + 2 * alpha)
    return F.when(matched, F.ln(m / u)).otherwise(F.ln((1 - m) / (1 - u)))


def posterior(log_odds: Column) -> Column:
    return 1 / (1 + F.exp(-log_odds))


def brier(p: Column, outcome: Column) -> Column:
    return F.avg((p - outcome) * (p - outcome))


def log_loss(p: Column, outcome: Column, eps: float = 1e-9) -> Column:
    q = F.least(F.greatest(p, F.lit(eps)), F.lit(1 - eps))
    return F.avg(-(outcome * F.ln(q) + (1 - outcome) * F.ln(1 - q)))
