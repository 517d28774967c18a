"""Numeric column helpers shared by the metric and chart operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_of(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` as DOUBLE; 0.0 where the base is zero."""
    share = part.cast("double") / whole.cast("double") * F.lit(100.0)
    return F.when(whole > 0, share).otherwise(F.lit(0.0))


def round_tenths(value: Column) -> Column:
    """Round to one decimal, half-to-even on the exact binary value.

    Spark's ``round`` works on the shortest decimal text of a double, so 0.35
    (stored slightly below 0.35) becomes 0.4. Published percentages follow the
    stored value. With ``n = floor(10v)`` the midpoint is ``(2n + 1) / 20``;
    ``(16v - (2n + 1)) + 4v`` has the sign of ``20v - (2n + 1)`` and is exact
    near the midpoint because both subtractions are between close doubles.
    """
    magnitude = F.abs(value)
    lower = F.floor(magnitude * F.lit(10.0)).cast("double")
    midpoint = lower * F.lit(2.0) + F.lit(1.0)
    side = (magnitude * F.lit(16.0) - midpoint) + magnitude * F.lit(4.0)
    up = (side > 0) | ((side == 0) & (lower % F.lit(2.0) == 1))
    tenths = lower + F.when(up, F.lit(1.0)).otherwise(F.lit(0.0))
    rounded = tenths / F.lit(10.0)
    return F.when(value < 0, -rounded).otherwise(rounded)
