"""Scalar score expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.config import ScoringWeights

PERPLEXITY_CAP = 10000.0


def order_hash(key: Column, seed: int) -> Column:
    """A text that sorts rows in a random order fixed by the seed and the key alone."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def hash_uniform(key: Column, seed: int) -> Column:
    """A number in [0, 1) fixed by the seed and the key, whatever the partitioning."""
    head = F.conv(F.substring(order_hash(key, seed), 1, 8), 16, 10)
    return head.cast("double") / F.lit(float(2**32))


def random_score(key: Column, seed: int = 42, low: float = 0.3, high: float = 1.0) -> Column:
    return F.lit(low) + F.lit(high - low) * hash_uniform(key, seed)


def perplexity(mean_nll: Column) -> Column:
    """Capped, and null where there is no loss (``least`` alone would give the cap)."""
    return F.when(mean_nll.isNotNull(), F.least(F.exp(mean_nll), F.lit(PERPLEXITY_CAP)))


def weighted(weights: ScoringWeights, learning: Column, quality: Column, diversity: Column) -> Column:
    return (
        F.lit(weights.learning_value) * learning
        + F.lit(weights.quality) * quality
        + F.lit(weights.diversity) * diversity
    )


def balance_ratio(user: Column, assistant: Column) -> Column:
    """0 when both sides write equally much, towards 1 when one side does the talking.

    Null when either side is silent.
    """
    both = (user > 0) & (assistant > 0)
    return F.when(both, F.try_divide(F.abs(user - assistant), user + assistant))


def as_percent(ratio: Column) -> Column:
    return F.format_string("%.2f%%", ratio * F.lit(100.0))


def reduction(before: Column, after: Column) -> Column:
    """Share of rows lost, 1 when there were none to begin with."""
    return F.when(before > 0, F.try_divide(before - after, before)).otherwise(F.lit(1.0))


def relative_improvement(base: Column, new: Column) -> Column:
    return F.when(base > 0, F.try_divide(base - new, base) * F.lit(100.0)).otherwise(F.lit(0.0))
