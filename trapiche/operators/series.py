"""Figures over the ordered season series.

Input is the season table: one row per season, or per group and season with
`group_cols`. Windows without group columns therefore run over a handful of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trapiche.config import DEFAULT_SPEC, FeedSpec

TRAILING_SEASONS = 3
DEFAULT_GROWTH = 1.02


def data_range(
    df: DataFrame, *columns: str, group_cols: Sequence[str] = (), where: Column | None = None
) -> DataFrame:
    """Smallest and largest value over the columns together, of the rows that `where` admits."""
    values = [F.col(c) if where is None else F.when(where, F.col(c)) for c in columns]
    lows = [F.min(v) for v in values]
    highs = [F.max(v) for v in values]
    low = F.least(*lows) if len(lows) > 1 else lows[0]
    high = F.greatest(*highs) if len(highs) > 1 else highs[0]
    return df.groupBy(*group_cols).agg(low.alias("low"), high.alias("high"))


def series_summary(
    seasons: DataFrame,
    measure: str | None = None,
    spec: FeedSpec = DEFAULT_SPEC,
    group_cols: Sequence[str] = (),
) -> DataFrame:
    """Mean, smallest and largest season, and their labels (the first one on ties)."""
    value, season = F.col(measure or spec.output), F.col(spec.season)
    return seasons.groupBy(*group_cols).agg(
        F.avg(value).alias("promedio"),
        F.min(value).alias("minimo"),
        F.max(value).alias("maximo"),
        F.min(F.struct(value, season.alias("label"))).getField("label").alias("zafra_minimo"),
        F.min(F.struct(-value, season.alias("label"))).getField("label").alias("zafra_maximo"),
    )


def with_previous_ratio(
    seasons: DataFrame,
    measure: str | None = None,
    spec: FeedSpec = DEFAULT_SPEC,
    group_cols: Sequence[str] = (),
) -> DataFrame:
    """Add `ratio` to the previous season; null for the first one and after a zero."""
    value = F.col(measure or spec.net).cast("double")
    by_season = Window.partitionBy(*group_cols).orderBy(spec.season)
    return seasons.withColumn("ratio", F.try_divide(value, F.lag(value).over(by_season)))


def growth_factor(
    seasons: DataFrame,
    measure: str | None = None,
    spec: FeedSpec = DEFAULT_SPEC,
    group_cols: Sequence[str] = (),
    min_seasons: int = 1,
    default: float | None = None,
) -> DataFrame:
    """Mean ratio of a season to the one before; `default` below `min_seasons` seasons."""
    ratios = with_previous_ratio(seasons, measure, spec, group_cols)
    return ratios.groupBy(*group_cols).agg(_mean_ratio(min_seasons, default).alias("growth"))


def _mean_ratio(min_seasons: int, default: float | None) -> Column:
    short = F.count("*") < min_seasons
    return F.when(short, F.lit(default).cast("double")).otherwise(F.avg("ratio"))


def trailing_mean(
    seasons: DataFrame,
    measure: str | None = None,
    spec: FeedSpec = DEFAULT_SPEC,
    group_cols: Sequence[str] = (),
    k: int = TRAILING_SEASONS,
) -> DataFrame:
    """Mean of the last k seasons, or the last season when there are fewer than k."""
    recent = with_recency(seasons, spec, group_cols).where(F.col("recency") <= k)
    return recent.groupBy(*group_cols).agg(
        _trailing_mean(measure or spec.net, k).alias("trailing_mean")
    )


def with_recency(
    seasons: DataFrame, spec: FeedSpec = DEFAULT_SPEC, group_cols: Sequence[str] = ()
) -> DataFrame:
    """Add `recency`: 1 for the last season, 2 for the one before."""
    last_first = Window.partitionBy(*group_cols).orderBy(F.desc(spec.season))
    return seasons.withColumn("recency", F.row_number().over(last_first))


def _trailing_mean(measure: str, k: int) -> Column:
    recent = F.when(F.col("recency") <= k, F.col(measure))
    last = F.max(F.when(F.col("recency") == 1, F.col(measure)))
    return F.when(F.count(recent) >= k, F.avg(recent)).otherwise(last)


def outlook(
    seasons: DataFrame,
    measure: str | None = None,
    spec: FeedSpec = DEFAULT_SPEC,
    group_cols: Sequence[str] = (),
    k: int = TRAILING_SEASONS,
    default_growth: float = DEFAULT_GROWTH,
) -> DataFrame:
    """What a forecast starts from, in one pass: trailing mean, growth, last season label."""
    measure = measure or spec.net
    ordered = with_recency(
        with_previous_ratio(seasons, measure, spec, group_cols), spec, group_cols
    )
    return ordered.groupBy(*group_cols).agg(
        _trailing_mean(measure, k).alias("trailing_mean"),
        _mean_ratio(k, default_growth).alias("growth"),
        F.max(spec.season).alias("last_season"),
    )
