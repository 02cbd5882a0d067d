"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def euclid(dx: Column, dy: Column) -> Column:
    return F.sqrt(dx * dx + dy * dy)


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, null when the whole is zero."""
    return F.try_divide(F.lit(100.0) * part, whole)


def log2_or_null(x: Column) -> Column:
    return F.log2(F.nullif(x.cast("double"), F.lit(0.0)))


def scale_by_max(x: Column, largest: Column) -> Column:
    """x * (1 / max)."""
    return x * F.try_divide(F.lit(1.0), largest)


def min_max(x: Column, smallest: Column, largest: Column) -> Column:
    return F.try_divide(x - smallest, largest - smallest)


def correlation(a: Column, b: Column) -> Column:
    """Pearson correlation as an aggregate; null where a side is constant (``corr`` raises there)."""
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a.cast("double")), F.when(both, b.cast("double"))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
