"""Closed-form statistics as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wilson(k: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Bounds of the Wilson interval; (0, 1) without observations."""
    k, n = k.cast("double"), n.cast("double")
    p = k / n
    denominator = 1 + z * z / n
    centre = (p + z * z / (2 * n)) / denominator
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / denominator
    return F.when(n == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), centre - half)), F.when(n == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), centre + half))


def rate(k: Column, n: Column, digits: int = 4) -> list[Column]:
    """k, n, rate and interval, rounded; the rate is null without observations (A10)."""
    low, high = wilson(k, n)
    return [k.alias("k"), n.alias("n"), F.round(F.when(n > 0, k / n), digits).alias("rate"), F.round(low, digits).alias("ci_low"), F.round(high, digits).alias("ci_high")]


def jaccard(a: Column, b: Column) -> Column:
    """Of two sets; 1 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)
