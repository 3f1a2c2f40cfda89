"""Sums and guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(c: Column, scale: int | None = None) -> Column:
    """``SUM(c)`` as double.

    With ``scale`` the values are summed as decimals of that scale, so the result
    does not depend on the order in which tasks finish. Use it for amounts whose
    number of decimals is known; without it the sum is a plain double sum.
    """
    if scale is None:
        return F.sum(c.cast("double"))
    return F.sum(c.cast(f"decimal(18,{scale})")).cast("double")


def mean(c: Column, scale: int | None = None) -> Column:
    """``AVG(c)`` as double, from an exact sum where ``scale`` is given."""
    if scale is None:
        return F.avg(c.cast("double"))
    # NULLIF: a group of NULLs only has no mean, and ANSI mode raises on x / 0.
    return total(c, scale) / F.nullif(F.count(c), F.lit(0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` as double, NULL where the denominator is 0 or NULL."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def positive_ratio(numerator: Column, denominator: Column) -> Column:
    """Like :func:`ratio`, but NULL for a negative denominator as well."""
    return F.when(denominator > 0, numerator.cast("double") / denominator.cast("double"))
