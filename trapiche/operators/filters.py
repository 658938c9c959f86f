"""Row filters chosen by a user of the tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trapiche.config import DEFAULT_SPEC, FeedSpec

COMPLETE_SHARE = 0.1


def select_season_producer(
    df: DataFrame,
    season: str | None = None,
    producer: str | None = None,
    spec: FeedSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Rows of one season and one producer; None stands for all of them.

    A producer is ignored on tables that have no producer column (the season table).
    """
    if season is not None:
        df = df.where(F.col(spec.season) == season)
    if producer is not None and spec.producer in df.columns:
        df = df.where(F.col(spec.producer) == producer)
    return df


def filter_columns(
    df: DataFrame,
    contains: Mapping[str, str] | None = None,
    between: Mapping[str, tuple[float | None, float | None]] | None = None,
) -> DataFrame:
    """Per-column filters of a result grid: text contains (any case), number within bounds."""
    for column, text in (contains or {}).items():
        df = df.where(F.lower(column).contains(text.lower()))
    for column, (low, high) in (between or {}).items():
        if low is not None:
            df = df.where(F.col(column) >= low)
        if high is not None:
            df = df.where(F.col(column) <= high)
    return df


def positive_only(df: DataFrame, measure: str) -> DataFrame:
    return df.where(F.col(measure) > 0)


def complete_seasons(
    seasons: DataFrame,
    spec: FeedSpec = DEFAULT_SPEC,
    share: float = COMPLETE_SHARE,
    group_cols: Sequence[str] = (),
) -> DataFrame:
    """Seasons above a share of the best season; all of them when none qualifies.

    Works on the season table. The best season of a group comes from a window, so the
    table is read once.
    """
    best = F.max(spec.output).over(Window.partitionBy(*group_cols))
    flagged = seasons.withColumn("_best", best)
    # Nothing exceeds a share below one of a maximum that is not positive.
    qualifies = (F.col(spec.output) > F.col("_best") * share) | (F.col("_best") <= 0)
    return flagged.where(qualifies).drop("_best")
