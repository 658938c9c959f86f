"""Columns derived from the measures of one row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trapiche.config import DEFAULT_SPEC, FeedSpec
from trapiche.functions.numbers import guarded_ratio
from trapiche.functions.seasons import start_year


def derive_yields(df: DataFrame, spec: FeedSpec = DEFAULT_SPEC) -> DataFrame:
    """Industrial yield and extraction efficiency in percent, and the season's first year."""
    net, gross, area, output = (F.col(c) for c in (spec.net, spec.gross, spec.area, spec.output))
    return df.withColumns(
        {
            spec.industrial_yield: guarded_ratio(output, net, 100.0, area),
            spec.extraction: guarded_ratio(net, gross, 100.0),
            spec.start_year: start_year(F.col(spec.season)),
        }
    )


def with_start_year(df: DataFrame, spec: FeedSpec = DEFAULT_SPEC) -> DataFrame:
    """Add the season's first year unless the table has it."""
    if spec.start_year in df.columns:
        return df
    return df.withColumn(spec.start_year, start_year(F.col(spec.season)))


def scale_columns(df: DataFrame, columns: dict[str, float]) -> DataFrame:
    """Divide columns by a unit, such as 1e6 for millions."""
    return df.withColumns({c: F.col(c) / unit for c, unit in columns.items()})
