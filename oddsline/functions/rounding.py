"""Rounding of doubles."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from oddsline.functions.times import as_column


def half_away(value: Column | str, digits: int) -> Column:
    """The scaled double rounded to a whole number, halves away from zero, and scaled back.

    This is what databases compute with doubles. ``round`` goes by the decimal digits instead: it
    takes 0.5196875 to 0.519688, although a million times that double lies below 519687.5. The
    sign of a zero is kept; numbers too large to be scaled stay as they are.
    """
    number, scale = as_column(value), F.lit(float(10 ** digits))
    scaled = number * scale
    nearest = F.round(scaled, 0) / scale
    signed = F.when(nearest == 0, number * F.lit(0.0)).otherwise(nearest)
    return F.when(F.abs(scaled) < F.lit(float("inf")), signed).otherwise(number)
