"""Season labels (`"2015-2016"`) and month labels as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _part(season: Column, index: int) -> Column:
    # `get` gives null past the end, so labels without a second part stay null.
    return F.get(F.split(season, "-"), index).try_cast("int")


def start_year(season: Column) -> Column:
    """Year before the dash; null without a dash or when it is not a number."""
    return F.when(season.contains("-"), _part(season, 0))


def end_year(season: Column) -> Column:
    """Year after the dash, or null."""
    return F.when(season.contains("-"), _part(season, 1))


def next_season(season: Column) -> Column:
    """`"2024-2025"` -> `"2025-2026"`; null when the label does not parse."""
    following = F.concat_ws("-", start_year(season) + 1, end_year(season) + 1)
    return F.when(start_year(season).isNotNull() & end_year(season).isNotNull(), following)


def in_season_range(season: Column, first: str, last: str) -> Column:
    """Labels as long as `first` that lie between both, compared as text."""
    return (F.length(season) == len(first)) & season.between(first, last)


def month_label(year: Column, month: Column) -> Column:
    """`"YYYY-MM"`."""
    return F.format_string("%d-%02d", year, month)
