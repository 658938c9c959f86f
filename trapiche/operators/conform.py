"""Bring text columns to one schema: season range, projection, types, missing values."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trapiche.config import DEFAULT_SPEC, FeedSpec
from trapiche.functions.numbers import number_or_zero, parse_number
from trapiche.functions.seasons import in_season_range


def keep_season_range(df: DataFrame, spec: FeedSpec = DEFAULT_SPEC) -> DataFrame:
    """Rows of the configured seasons; a table without a season column passes unchanged."""
    if spec.season not in df.columns:
        return df
    return df.where(in_season_range(F.col(spec.season), spec.first_season, spec.last_season))


def keep_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in list order."""
    return df.select(*[c for c in columns if c in df.columns])


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def numeric_text_columns(df: DataFrame, columns: Iterable[str] | None = None) -> list[str]:
    """Text columns that hold numbers, decided from the data in one aggregate.

    A column is numeric when strictly more than half of all rows parse, or when no
    cell at all fails to parse (a sparse or empty column of numbers).
    """
    candidates = list(columns) if columns is not None else _text_columns(df)
    if not candidates:
        return []
    counts = df.agg(
        F.count("*").alias("rows"),
        *[F.count(parse_number(F.col(c))).alias(f"parsed_{i}") for i, c in enumerate(candidates)],
        *[F.count(F.col(c)).alias(f"present_{i}") for i, c in enumerate(candidates)],
    ).first()
    return [
        c
        for i, c in enumerate(candidates)
        if counts[f"parsed_{i}"] > 0.5 * counts["rows"]
        or counts[f"parsed_{i}"] == counts[f"present_{i}"]
    ]


def cast_numbers(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Text columns to numbers; what does not parse becomes 0."""
    text = set(_text_columns(df)) & set(columns)
    return df.select(*[number_or_zero(F.col(c)).alias(c) if c in text else F.col(c) for c in df.columns])


def fill_missing(df: DataFrame) -> DataFrame:
    """Missing numbers become 0, missing texts the empty string."""
    return df.na.fill(0).na.fill("")


def drop_unmeasured(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Drop rows where all the measures are missing (none are, once `fill_missing` has run)."""
    return df.na.drop(how="all", subset=[m for m in measures if m in df.columns])


def conform_types(
    df: DataFrame, spec: FeedSpec = DEFAULT_SPEC, numeric: Iterable[str] | None = None
) -> DataFrame:
    """Numbers, missing values and empty rows as the later steps expect them.

    `numeric` names the text columns to convert; when None they are decided from the
    data, which costs one pass. The four main measures are always converted.
    """
    decided = numeric_text_columns(df) if numeric is None else list(numeric)
    typed = fill_missing(cast_numbers(df, [*decided, *spec.forced_numeric]))
    return drop_unmeasured(typed, [spec.net, spec.output])
