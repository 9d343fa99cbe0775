"""Vector arithmetic on arrays, in double precision."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays; 0 when either one has no length."""
    scale = norm(a) * norm(b)
    return F.when(scale > 0, dot(a, b) / scale).otherwise(F.lit(0.0))


def density_ratio(prob: Column, low: float = 0.5, high: float = 10.0) -> Column:
    """p / (1 - p + 1e-8) held within [low, high]."""
    ratio = prob / (F.lit(1.0) - prob + F.lit(1e-8))
    return F.least(F.greatest(ratio, F.lit(low)), F.lit(high))


def array_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
