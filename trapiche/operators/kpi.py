"""Profile, headline figures, rankings and choice lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trapiche.config import DEFAULT_SPEC, FeedSpec
from trapiche.functions.numbers import guarded_ratio

TOP_PRODUCERS = 15
PREVIEW_ROWS = 100


def profile(detail: DataFrame, spec: FeedSpec = DEFAULT_SPEC, approximate: bool = False) -> DataFrame:
    """Rows, distinct seasons, distinct producers and column names, as one row.

    `approximate` trades exact distinct counts for a fixed-size sketch.
    """

    def distinct(column: str) -> Column:
        if column not in detail.columns:
            return F.lit(0).cast("long")
        return F.approx_count_distinct(column) if approximate else F.count_distinct(column)

    return detail.agg(
        F.count("*").alias("total_registros"),
        distinct(spec.season).alias("total_zafras"),
        distinct(spec.producer).alias("total_ingenios"),
    ).withColumn("columnas", F.array(*[F.lit(c) for c in detail.columns]))


def total_output(seasons: DataFrame, spec: FeedSpec = DEFAULT_SPEC) -> DataFrame:
    """Total output and number of seasons of a (filtered) season table; zeros when it is empty."""
    return seasons.agg(
        F.coalesce(F.sum(spec.output), F.lit(0.0)).alias("produccion_total"),
        F.count_distinct(spec.season).alias("n_zafras"),
    )


def weighted_yield(detail: DataFrame, spec: FeedSpec = DEFAULT_SPEC) -> DataFrame:
    """Output per net cane in percent over rows with cane; 0 when there are none."""
    milled = F.col(spec.net) > 0
    sums = detail.agg(
        F.sum(F.when(milled, F.col(spec.output))).alias("output"),
        F.sum(F.when(milled, F.col(spec.net))).alias("net"),
    )
    return sums.select(guarded_ratio(F.col("output"), F.col("net"), 100.0).alias("rendimiento"))


def model_figures(metrics: DataFrame) -> DataFrame:
    """Test R2 and MAE of a metrics record; null where the record lacks them."""

    def figure(name: str) -> Column:
        return F.col(name) if name in metrics.columns else F.lit(None).cast("double").alias(name)

    return metrics.select(figure("test_r2"), figure("test_mae"))


def output_by_producer(detail: DataFrame, spec: FeedSpec = DEFAULT_SPEC) -> DataFrame:
    return detail.groupBy(spec.producer).agg(F.sum(spec.output).alias(spec.output))


def top_producers(detail: DataFrame, n: int = TOP_PRODUCERS, spec: FeedSpec = DEFAULT_SPEC) -> DataFrame:
    """Producers with the largest output; equal sums in name order."""
    ranked = output_by_producer(detail, spec).orderBy(F.desc(spec.output), spec.producer)
    return ranked.limit(n)


def round_numbers(df: DataFrame, places: int, columns: Sequence[str] | None = None) -> DataFrame:
    """Round numeric columns half to even."""
    floating = (T.DoubleType, T.FloatType, T.DecimalType)
    chosen = columns or [f.name for f in df.schema if isinstance(f.dataType, floating)]
    return df.withColumns({c: F.bround(c, places) for c in chosen})


def preview(detail: DataFrame, rows: int = PREVIEW_ROWS, spec: FeedSpec = DEFAULT_SPEC) -> DataFrame:
    """First rows in key order with the display columns that exist, numbers to two places."""
    shown = (spec.producer, spec.season, spec.net, spec.output, spec.area, *spec.reported_yields)
    chosen = detail.select(*[c for c in shown if c in detail.columns])
    return round_numbers(chosen.orderBy(spec.producer, spec.season).limit(rows), 2)


def choices(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values of a column."""
    return df.select(column).distinct().orderBy(column)


def season_series(
    seasons: DataFrame, spec: FeedSpec = DEFAULT_SPEC, unit: float = 1e6
) -> DataFrame:
    """Output and cane per season in a larger unit, in season order."""
    return seasons.select(
        spec.season,
        (F.col(spec.output) / unit).alias(spec.output),
        (F.col(spec.net) / unit).alias(spec.net),
    ).orderBy(spec.season)
