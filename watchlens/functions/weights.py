"""Weights of segments and interactions, and the normal distribution."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from watchlens.schemas import INTERACTION_WEIGHTS, SEGMENT_WEIGHT_OTHER, SEGMENT_WEIGHTS


def segment_weight(segment: Column) -> Column:
    """Weight of a user segment, by the first known word it contains."""
    lowered = F.lower(F.coalesce(segment, F.lit("")))
    weight = F.lit(SEGMENT_WEIGHT_OTHER)
    for word, value in reversed(SEGMENT_WEIGHTS.items()):
        weight = F.when(lowered.contains(word), F.lit(value)).otherwise(weight)
    return weight


def interaction_weight(event_type: Column) -> Column:
    """How strongly an event type speaks for its content; unknown types weigh 0."""
    weight = F.lit(0)
    for name, value in INTERACTION_WEIGHTS.items():
        weight = F.when(event_type == name, F.lit(value)).otherwise(weight)
    return weight


def normal_cdf(z: Column) -> Column:
    """Standard normal distribution function, absolute error below 1e-7.

    Abramowitz and Stegun, Handbook of Mathematical Functions, 26.2.17.
    """
    # Fixed values of the formula.
    p = 0.2316419
    b = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
    t = 1.0 / (1.0 + p * F.abs(z))
    series = F.lit(0.0)
    for coefficient in reversed(b):
        series = (series + coefficient) * t
    upper = F.exp(-z * z / 2.0) / math.sqrt(2.0 * math.pi) * series
    return F.when(z >= 0, 1.0 - upper).otherwise(upper)
