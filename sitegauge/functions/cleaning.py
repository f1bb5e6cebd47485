"""Text to numbers. What does not parse is NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitegauge.functions.nested import whole_number

DECIMAL_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\z"
CLOCK_TEXT = r"^([01]?\d|2[0-3]):[0-5]?\d:[0-5]?\d\z"
ABBREVIATED_TEXT = r"^([+-]?\d+(?:\.\d+)?)\s*[KkMmBbTt]?\z"

# The letters of abbreviated counts.
MULTIPLIERS = {"K": 1_000, "M": 1_000_000, "B": 1_000_000_000, "T": 1_000_000_000_000}


def decimal_text(text: Column) -> Column:
    """Plain decimal text as a double."""
    return F.when(text.rlike(DECIMAL_TEXT), text.try_cast("double"))


def percent_text(text: Column) -> Column:
    """``36.03%`` as 36.03."""
    return decimal_text(F.btrim(text, F.lit("%")))


def clock_seconds(text: Column) -> Column:
    """``00:10:35`` as 635, in 64 bits; NULL outside 00:00:00 to 23:59:59."""
    seconds = F.aggregate(
        F.split(text, ":"),
        F.lit(0).cast("bigint"),
        lambda total, part: total * 60 + part.try_cast("bigint"),
    )
    return F.when(text.rlike(CLOCK_TEXT), seconds)


def abbreviated_number(text: Column) -> Column:
    """``87.0B`` as 87000000000, up to the largest bigint; decimal arithmetic, so that no digit is
    lost on the way. A fraction that is left goes; what is larger than a bigint is NULL."""
    trimmed = F.btrim(text)
    digits = F.regexp_extract(trimmed, ABBREVIATED_TEXT, 1)
    letters = [F.lit(part) for pair in MULTIPLIERS.items() for part in pair]
    factor = F.try_element_at(F.create_map(*letters), F.upper(F.right(trimmed, F.lit(1))))
    scaled = digits.try_cast("decimal(24,9)") * factor.cast("decimal(13,0)")
    plain = digits.try_cast("decimal(38,9)")
    return F.when(factor.isNull(), plain).otherwise(scaled).try_cast("bigint")


def counted(text: Column) -> Column:
    """A count in any spelling, ``18054``, ``2474684.0``, ``1e6`` or ``87.0B``, as bigint."""
    return F.coalesce(whole_number(text), abbreviated_number(text))
