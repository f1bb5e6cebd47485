"""Rounding, growth and sign."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(value: Column, digits: int = 2) -> Column:
    """Round a double with halves going away from zero.

    Works on the scaled binary value; ``F.round`` works on its decimal text and differs on
    some halves. From 2**52 up a double has no fraction left to round.
    """
    scale = F.lit(float(10**digits))
    scaled = F.abs(value) * scale
    whole = F.floor(scaled).cast("double")
    rounded = whole + F.when(scaled - whole >= 0.5, 1.0).otherwise(0.0)
    kept = F.when(scaled < float(2**52), rounded).otherwise(scaled) / scale
    return F.when(value < 0, -kept).otherwise(kept)


def difference(one: Column, other: Column) -> Column:
    """``one - other`` as a double; whole numbers exactly, unless that goes beyond 64 bits."""
    return F.coalesce(F.try_subtract(one, other).cast("double"), one.cast("double") - other.cast("double"))


def percent_step(current: Column, previous: Column) -> Column:
    """Change from the previous value in percent; NULL where that is NULL or 0."""
    base = F.nullif(previous, F.lit(0).cast("bigint"))
    return round_half_away(difference(current, previous) / base * F.lit(100.0))


def percent_span(first: Column, last: Column) -> Column:
    """Change from first to last in percent; NULL where the first is NULL or 0."""
    base = F.nullif(first, F.lit(0).cast("bigint"))
    return round_half_away(difference(last, first) * F.lit(100.0) / base)


def share_percent(share: Column) -> Column:
    """A share of 1 as a percentage."""
    return round_half_away(share * F.lit(100.0))


def sign_class(value: Column) -> Column:
    """1, -1 or 0; NULL counts as 0, unlike ``F.signum``."""
    return F.when(value > 0, 1).when(value < 0, -1).otherwise(0)
