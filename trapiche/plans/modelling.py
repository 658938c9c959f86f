"""From the processed tables to model, metrics and forecasts."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame

from trapiche.config import DEFAULT_SPEC, FeedSpec
from trapiche.operators.forecast import forecast_months, forecast_next_season, interpretation
from trapiche.operators.regression import (
    SEED,
    TEST_FRACTION,
    fit,
    inference,
    metrics,
    residual_squares,
    score,
    with_split,
)
from trapiche.sinks.writers import store, write_model, write_record


# Share of the variation left by a fit below which moments no longer tell the residuals.
NEAR_PERFECT = 1e-8


@dataclass(frozen=True)
class ModelResult:
    model: DataFrame
    stats: DataFrame
    metrics: DataFrame
    next_season: DataFrame
    interpretation: DataFrame


def run_model(
    seasons: DataFrame,
    detail: DataFrame | None,
    out_folder: str,
    test_fraction: float = TEST_FRACTION,
    seed: int = SEED,
    spec: FeedSpec = DEFAULT_SPEC,
) -> ModelResult:
    """Fit on the detail table (the season table when there is none), measure, forecast, write.

    Expects stored tables: each of the few passes reads three columns of them. The model
    fitted on the training rows and the statistics of the fit on all rows are kept apart,
    because point forecasts use the first and intervals the second.
    """
    data = detail if detail is not None else seasons
    keys = [c for c in (spec.producer, spec.season) if c in data.columns]
    rows = data.select(*keys, spec.net, spec.output)
    split = with_split(rows, keys, test_fraction, seed, exact=True)
    model = store(fit(split, where=~split["is_test"], spec=spec), f"{out_folder}/model")
    stats = _inference(rows, f"{out_folder}/inference", spec)
    scored = metrics(score(split, model, spec=spec), model, spec=spec)
    write_record(scored, f"{out_folder}/metrics")
    # Read back: what follows must not score the rows again.
    record = data.sparkSession.read.schema(scored.schema).json(f"{out_folder}/metrics")
    ahead = forecast_next_season(seasons, model, spec=spec)
    told = interpretation(record, ahead)
    write_record(told, f"{out_folder}/interpretation")
    return ModelResult(model, stats, record, ahead, told)


def _inference(rows: DataFrame, path: str, spec: FeedSpec) -> DataFrame:
    """Stored statistics of the fit on all rows.

    The sum of squared residuals comes from the moments, unless the fit is so good that their
    difference holds rounding only; then a second pass adds up the residuals themselves.
    """
    model = fit(rows, spec=spec)
    write_model(inference(model), path)
    stats = rows.sparkSession.read.parquet(path)
    r2 = stats.first()["R2"]
    if r2 is None or 1 - r2 >= NEAR_PERFECT:
        return stats
    model = store(model, f"{path}_moments")
    squares = residual_squares(rows, model, spec=spec)
    write_model(inference(model, squares=squares), path)
    return rows.sparkSession.read.parquet(path)


def monthly_outlook(
    seasons: DataFrame, result: ModelResult, as_of: dt.date, spec: FeedSpec = DEFAULT_SPEC
) -> DataFrame:
    """The 24-month forecast of a modelling run."""
    return forecast_months(seasons, result.model, result.stats, as_of, spec=spec)
