"""Exact decimal rounding without going through a floating-point tie."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded_ratio(num: Column, den: Column, digits: int = 2) -> Column:
    """``num / den`` rounded half away from zero, as DOUBLE; NULL if ``den`` is 0.

    Both sides are whole numbers (BIGINT or scale-0 DECIMAL) with ``den`` >= 0.
    The integer quotient decides the last digit, so every engine and every row
    order gives the same value.
    """
    unit = 10**digits
    den = F.nullif(den, F.lit(0))
    steps = F.call_function("div", F.abs(num) * F.lit(2 * unit) + den, den * F.lit(2))
    return F.signum(num.cast("double")) * steps.cast("double") / F.lit(float(unit))


def percent(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``, two digits."""
    return rounded_ratio(part * F.lit(100), whole)
