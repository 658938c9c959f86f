"""What a dashboard shows: the stored state with its fallbacks, and views of chosen rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from trapiche.config import DEFAULT_SPEC, FeedSpec
from trapiche.operators.filters import select_season_producer
from trapiche.operators.kpi import top_producers
from trapiche.operators.regression import fit, inference, sample_metrics, score
from trapiche.operators.scoring import actual_vs_predicted, confidence_band, line_grid
from trapiche.sources.tables import (
    INTERPRETATION_SCHEMA,
    METRICS_SCHEMA,
    read_detail,
    read_model,
    read_record,
    read_seasons,
)


@dataclass(frozen=True)
class DashboardState:
    """Tables and model of a run. `stats` describe the fit on all rows, for intervals."""

    detail: DataFrame | None
    seasons: DataFrame | None
    model: DataFrame
    stats: DataFrame
    metrics: DataFrame
    interpretation: DataFrame | None


def load_state(spark: SparkSession, folder: str, spec: FeedSpec = DEFAULT_SPEC) -> DashboardState:
    """Read what `run_etl` and `run_model` wrote below one folder.

    A missing model is fitted on all rows of the detail table, or of the season table when there
    is no detail. Missing metrics are those of the model on the same rows. Without either table
    there is nothing to show, which is an error.
    """
    detail, seasons = read_detail(spark, f"{folder}/detail", spec), read_seasons(
        spark, f"{folder}/seasons", spec
    )
    rows = detail if detail is not None else seasons
    if rows is None:
        raise FileNotFoundError(f"neither detail nor seasons in {folder}")
    fitted = fit(rows, spec=spec)
    stored, stats = read_model(spark, f"{folder}/model"), read_model(spark, f"{folder}/inference")
    model = stored if stored is not None else fitted
    record = read_record(spark, f"{folder}/metrics", METRICS_SCHEMA)
    return DashboardState(
        detail,
        seasons,
        model,
        stats if stats is not None else inference(fitted),
        record if record is not None else sample_metrics(rows, model, spec=spec),
        read_record(spark, f"{folder}/interpretation", INTERPRETATION_SCHEMA),
    )


def _chosen(
    state: DashboardState, season: str | None, producer: str | None, spec: FeedSpec
) -> DataFrame:
    rows = state.detail if state.detail is not None else state.seasons
    return select_season_producer(rows, season, producer, spec)


def filtered_band(
    state: DashboardState,
    season: str | None = None,
    producer: str | None = None,
    spec: FeedSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Line and confidence band over the range of the chosen rows, by the model of all rows."""
    grid = line_grid(_chosen(state, season, producer, spec), spec=spec)
    return confidence_band(grid, state.model, state.stats, spec=spec)


def filtered_parity(
    state: DashboardState,
    season: str | None = None,
    producer: str | None = None,
    spec: FeedSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Measured and predicted output of the chosen rows."""
    rows = _chosen(state, season, producer, spec)
    keys = [c for c in spec.keys if c in rows.columns]
    return actual_vs_predicted(score(rows, state.model, spec=spec), keys, spec=spec)


def filtered_top(
    state: DashboardState, season: str | None = None, spec: FeedSpec = DEFAULT_SPEC
) -> DataFrame:
    """The largest producers of the chosen season."""
    return top_producers(_chosen(state, season, None, spec), spec=spec)
