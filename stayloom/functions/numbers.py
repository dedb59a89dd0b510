"""Rounding and ratio rules that must agree between engines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col


def half_up(part: Column, whole: Column, places: int, scale: int = 1) -> Column:
    """``part * scale / whole`` of two non-negative counts, rounded half up on the exact quotient, as a double.

    Whole-number arithmetic throughout: no binary fraction is ever rounded. NULL when ``whole`` is zero.
    """
    p, w = part.cast("decimal(26,0)"), F.nullif(whole, F.lit(0)).cast("decimal(26,0)")
    units = F.call_function("div", p * F.lit(2 * scale * 10**places) + w, w * F.lit(2))
    return units.cast("double") / 10.0**places


def rounded_average(c: str | Column, places: int) -> Column:
    """Average of a non-negative integer column over its non-NULL rows, rounded half up."""
    return half_up(F.sum(col(c)), F.count(col(c)), places)


def percent(part: Column, whole: Column, places: int) -> Column:
    """``part / whole * 100``, rounded half up; 0 when there is nothing to divide by."""
    return F.coalesce(half_up(part, whole, places, 100), F.lit(0.0))


def ratio(part: Column, whole: Column) -> Column:
    """Quotient as a double; NULL when the divisor is zero or NULL."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def ratio_or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(ratio(part, whole), F.lit(0.0))
