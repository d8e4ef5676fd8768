"""Confidence, gating and rank fusion as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The confidence rules of the memory jobs.
CONFIDENCE_THRESHOLD = 0.6
HIGH_STAKES = ("interaction_claim", "dosing", "safety")
THIN_BELOW = 4
THIN_CAP = 0.5
CLUSTER_BASE, CLUSTER_STEP = 0.4, 0.1
THEME_BASE, THEME_STEP = 0.5, 0.05
CONTRADICTION_CONFIDENCE = 0.4
CLAIM_CONFIDENCE = 0.35

# Fixed value: the reciprocal rank fusion constant.
RRF_CONSTANT = 60


def cluster_confidence(
    n: Column,
    topic: Column,
    high_stakes: Sequence[str] = HIGH_STAKES,
    thin_below: int = THIN_BELOW,
) -> Column:
    """Rises with support; a high-stakes topic with thin support is capped."""
    rising = F.least(F.lit(1.0), F.lit(CLUSTER_BASE) + F.lit(CLUSTER_STEP) * n.cast("double"))
    thin = topic.isin(*high_stakes) & (n < thin_below)
    return F.when(thin, F.least(rising, F.lit(THIN_CAP))).otherwise(rising)


def theme_confidence(reps: Column) -> Column:
    """Rises with the number of independent owners."""
    return F.least(F.lit(1.0), F.lit(THEME_BASE) + F.lit(THEME_STEP) * reps.cast("double"))


def gate(
    confidence: Column, used_fallback: Column, threshold: float = CONFIDENCE_THRESHOLD
) -> Column:
    """`active` from the threshold up on the unrounded value; placeholder text is always held."""
    return (
        F.when(used_fallback, F.lit("review"))
        .when(confidence >= F.lit(float(threshold)), F.lit("active"))
        .otherwise(F.lit("review"))
    )


def reciprocal_rank(rank: Column, constant: int = RRF_CONSTANT) -> Column:
    """`1 / (constant + rank)` in doubles; a leg without the row contributes 0."""
    return F.coalesce(F.lit(1.0) / (F.lit(float(constant)) + rank.cast("double")), F.lit(0.0))
