"""Parsing, guarded arithmetic and rounding as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trapiche.config import MISSING_TOKENS


# Every text that the cast takes, but for those that end in a type suffix.
_NUMBER = (
    r"\A[\x00-\x20]*[+-]?(?:"
    r"(?:[0-9.]++(?:[eE][+-]?[0-9]+)?|0[xX][0-9a-fA-FpP.+-]*[0-9])(?:[dDfF](?![ \t\r\n]*\z))?"
    r"|[iInN][a-zA-Z]+)[\x00-\x20]*\z"
)


def missing_to_null(text: Column) -> Column:
    """Null for the cell texts that stand for a missing value."""
    return F.when(~text.isin(*MISSING_TOKENS), text)


def parse_number(text: Column) -> Column:
    """Number in a text cell, or null. Thousands separators do not parse; `NaN` is missing.

    The cast alone would also take Java's type suffixes (`12d`), which are not numbers here. One
    pattern tells before the cast: texts that do not parse would cost an exception each, and a
    projection that parses a dozen columns has to stay below the size of method that the JVM
    compiles.
    """
    value = F.nanvl(text.try_cast("double"), F.lit(None).cast("double"))
    return F.when(text.rlike(_NUMBER), value)


def number_or_zero(text: Column) -> Column:
    return F.coalesce(parse_number(text), F.lit(0.0))


def guarded_ratio(top: Column, bottom: Column, scale: float = 1.0, *also_positive: Column) -> Column:
    """`top / bottom * scale` where `bottom` (and every further guard) is positive, else 0."""
    guard = bottom > 0
    for other in also_positive:
        guard = guard & (other > 0)
    ratio = top.cast("double") / bottom.cast("double")
    return F.when(guard, ratio if scale == 1.0 else ratio * scale).otherwise(F.lit(0.0))


def clamp_at_zero(value: Column) -> Column:
    """Production cannot be negative."""
    return F.greatest(F.lit(0.0), value)


def percent_change(value: Column, previous: Column, zero_base: str = "infinite") -> Column:
    """Growth in percent; null when there is no previous value.

    Growth from zero is infinite (and 0 from zero to zero), or null with `zero_base="null"`.
    """
    value, previous = value.cast("double"), previous.cast("double")
    growth = (F.try_divide(value, previous) - 1.0) * 100.0
    if zero_base == "null":
        return growth
    if zero_base != "infinite":
        raise ValueError(f"zero_base must be 'infinite' or 'null', got {zero_base!r}")
    from_zero = (
        F.when(value > 0, F.lit(float("inf"))).when(value < 0, F.lit(float("-inf"))).otherwise(F.lit(0.0))
    )
    return F.when(previous == 0, from_zero).otherwise(growth)
