"""Season roll-up with ratios of sums and growth over the previous season."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trapiche.config import DEFAULT_SPEC, FeedSpec
from trapiche.functions.numbers import guarded_ratio, percent_change


def season_sums(
    detail: DataFrame,
    spec: FeedSpec = DEFAULT_SPEC,
    measures: Sequence[str] | None = None,
    group_cols: Sequence[str] = (),
) -> DataFrame:
    """Sum of every measure per season (and group)."""
    measures = spec.summed if measures is None else measures
    return detail.groupBy(*group_cols, spec.season).agg(*[F.sum(m).alias(m) for m in measures])


def with_season_ratios(seasons: DataFrame, spec: FeedSpec = DEFAULT_SPEC) -> DataFrame:
    """Sugar per cane in percent and cane per area, taken from the season sums."""
    net, area, output = F.col(spec.net), F.col(spec.area), F.col(spec.output)
    return seasons.withColumns(
        {
            spec.season_yield: guarded_ratio(output, net, 100.0),
            spec.season_field_yield: guarded_ratio(net, area),
        }
    )


def with_growth(
    seasons: DataFrame,
    spec: FeedSpec = DEFAULT_SPEC,
    measure: str | None = None,
    group_cols: Sequence[str] = (),
    first: float | None = 0.0,
    zero_base: str = "infinite",
) -> DataFrame:
    """Percent change of a measure over the previous season; `first` stands where there is none.

    The window runs over the season table, which has one row per season and group.
    """
    value = F.col(measure or spec.output)
    by_season = Window.partitionBy(*group_cols).orderBy(spec.season)
    growth = percent_change(value, F.lag(value).over(by_season), zero_base)
    if first is not None:
        # pandas-style fill: the first season and nothing else has no previous value.
        growth = F.when(F.row_number().over(by_season) == 1, F.lit(float(first))).otherwise(growth)
    return seasons.withColumn(spec.growth, growth)


def season_rollup(
    detail: DataFrame,
    spec: FeedSpec = DEFAULT_SPEC,
    group_cols: Sequence[str] = (),
    first_growth: float | None = 0.0,
    zero_base: str = "infinite",
) -> DataFrame:
    """Season table: sums, ratios and growth, in season order.

    Per group the table grows with the groups and is left unsorted.
    """
    sums = season_sums(detail, spec, group_cols=group_cols)
    grown = with_growth(
        with_season_ratios(sums, spec),
        spec,
        group_cols=group_cols,
        first=first_growth,
        zero_base=zero_base,
    )
    return grown if group_cols else grown.orderBy(spec.season)
