"""Bounded scores: log scales, weights and null-skipping blends."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalith.constants import Scale


def half_even(c: Column) -> Column:
    """Nearest integer, halves to even."""
    return F.bround(c).cast("bigint")


def log_scale(value: Column, scale: Scale) -> Column:
    """Positive count on a clamped log10 scale of 0..100."""
    t = (F.log10(value.cast("double")) - scale.low) / (scale.high - scale.low)
    return F.when(value > 0, F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0)) * 100.0)


def log_weight(count: Column) -> Column:
    return F.when(count > 0, F.lit(1.0) + F.log10(F.lit(1.0) + count.cast("double"))).otherwise(0.0)


def weighted_average(pairs: list[tuple[Column, Column | float]]) -> Column:
    """Mean of the present values weighted by their positive weights; NULL when nothing counts."""
    num, den = F.lit(0.0), F.lit(0.0)
    for value, weight in pairs:
        w = F.lit(float(weight)) if isinstance(weight, (int, float)) else weight
        counts = value.isNotNull() & (w > 0)
        num = num + F.when(counts, value * w).otherwise(0.0)
        den = den + F.when(counts, w).otherwise(0.0)
    return F.when(den > 0, num / den)


def blend(pairs: list[tuple[Column, Column | float]]) -> Column:
    return half_even(weighted_average(pairs))


def sum_if_any(parts: list[Column]) -> Column:
    """Sum of the present parts, NULL when all are missing."""
    total = F.lit(0).cast("bigint")
    for p in parts:
        total = total + F.coalesce(p, F.lit(0)).cast("bigint")
    return F.when(F.coalesce(*parts).isNotNull(), total)


def within_0_100(c: Column) -> Column:
    return F.when(c.between(0, 100), c)
