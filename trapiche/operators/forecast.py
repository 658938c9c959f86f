"""Forecasts from the season series and a fitted model.

With `group_cols` every group is forecast in the same job.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trapiche.config import DEFAULT_SPEC, FeedSpec
from trapiche.functions.seasons import end_year, month_label, next_season
from trapiche.operators.filters import complete_seasons
from trapiche.operators.kpi import round_numbers
from trapiche.operators.regression import attach, score
from trapiche.operators.scoring import prediction_interval
from trapiche.operators.series import outlook, with_previous_ratio

FORECAST_MONTHS = 24
# The yearly swing of milling around its mean and the month it starts from.
SEASONAL_SWING = 0.4
SEASONAL_ORIGIN_MONTH = 2


def forecast_next_season(
    seasons: DataFrame,
    model: DataFrame,
    group_cols: Sequence[str] = (),
    spec: FeedSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Cane of the last season times its mean ratio, and the output the model gives for it."""
    ratios = with_previous_ratio(seasons, spec.net, spec, group_cols)
    ahead = ratios.groupBy(*group_cols).agg(
        F.max(spec.season).alias("_last"),
        F.max_by(spec.net, spec.season).alias("_last_net"),
        F.avg("ratio").alias("tendencia_cana"),
    ).where(F.col("_last").isNotNull())
    ahead = ahead.withColumns(
        {
            spec.season: next_season(F.col("_last")),
            "siguiente_cana": F.col("_last_net") * F.col("tendencia_cana"),
        }
    )
    scored = score(ahead, model, "siguiente_cana", group_cols=group_cols, spec=spec)
    return scored.select(
        *group_cols,
        spec.season,
        "siguiente_cana",
        F.col("y_hat").alias("siguiente_azucar"),
        "tendencia_cana",
    )


def history_with_forecast(
    seasons: DataFrame,
    ahead: DataFrame,
    group_cols: Sequence[str] = (),
    spec: FeedSpec = DEFAULT_SPEC,
) -> DataFrame:
    """The season series followed by its forecast row, told apart by `tipo`."""
    past = seasons.select(*group_cols, spec.season, spec.net, spec.output, F.lit("real").alias("tipo"))
    future = ahead.select(
        *group_cols,
        spec.season,
        F.col("siguiente_cana").alias(spec.net),
        F.col("siguiente_azucar").alias(spec.output),
        F.lit("pronostico").alias("tipo"),
    )
    return past.unionByName(future)


def forecast_months(
    seasons: DataFrame,
    model: DataFrame,
    stats: DataFrame,
    as_of: dt.date,
    months: int = FORECAST_MONTHS,
    alpha: float | None = None,
    group_cols: Sequence[str] = (),
    spec: FeedSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Monthly cane and output from `as_of` on.

    A twelfth of the recent mean, grown by the mean ratio and swung over the year, goes
    through `model`; the bounds come from `stats`. Partial seasons are left out. Figures
    are rounded to whole units, half to even.
    """
    start = outlook(complete_seasons(seasons, spec, group_cols=group_cols), spec.net, spec, group_cols)
    start = start.where(F.col("last_season").isNotNull())
    year = F.greatest(end_year(F.col("last_season")), F.lit(as_of.year))
    steps = start.select(
        *group_cols,
        "trailing_mean",
        "growth",
        year.alias("_year"),
        F.explode(F.sequence(F.lit(0), F.lit(months - 1))).alias("_i"),
    )
    elapsed = F.lit(as_of.month - 1) + F.col("_i")
    dated = steps.withColumns(
        {
            "Mes": (elapsed % 12 + 1).cast("int"),
            "Anio": (F.col("_year") + F.floor(elapsed / 12)).cast("int"),
        }
    )
    swing = 1.0 + SEASONAL_SWING * F.sin(F.pi() * (F.col("Mes") - SEASONAL_ORIGIN_MONTH) / 6)
    grown = F.col("trailing_mean") * F.pow(F.col("growth"), (F.col("_i") + 1) / 12.0) / 12
    cane = dated.withColumns(
        {"Periodo": month_label(F.col("Anio"), F.col("Mes")), "Cana_Molida_ton": grown * swing}
    )
    pointed = score(cane, model, "Cana_Molida_ton", group_cols=group_cols, spec=spec)
    bounded = prediction_interval(pointed, stats, "Cana_Molida_ton", alpha, group_cols, spec)
    table = bounded.select(
        *group_cols,
        "Periodo",
        "Mes",
        "Anio",
        "Cana_Molida_ton",
        F.col("y_hat").alias("Azucar_Producida_ton"),
        F.col("lower").alias("Inferior_95"),
        F.col("upper").alias("Superior_95"),
    )
    figures = ("Cana_Molida_ton", "Azucar_Producida_ton", "Inferior_95", "Superior_95")
    return round_numbers(table, 0, figures)


def forecast_display(forecast: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """The forecast table under its display headings, which are fixed values."""
    return forecast.select(
        *group_cols,
        "Periodo",
        F.col("Cana_Molida_ton").alias("Cana Molida (ton)"),
        F.col("Azucar_Producida_ton").alias("Azucar Prod. (ton)"),
        F.col("Inferior_95").alias("IC Inf. 95%"),
        F.col("Superior_95").alias("IC Sup. 95%"),
    )


def forecast_total(forecast: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    return forecast.groupBy(*group_cols).agg(F.sum("Azucar_Producida_ton").alias("total_azucar"))


def interpretation(
    record: DataFrame, ahead: DataFrame, group_cols: Sequence[str] = ()
) -> DataFrame:
    """Model, fit and forecast as one nested record; field names and sentences are fixed values."""
    b0, b1, r2 = F.col("intercepto_B0"), F.col("coeficiente_B1"), F.col("test_r2")

    def sentence(pattern: str, *values: Column) -> Column:
        return F.format_string(pattern, *values)

    forecast = ahead.select(
        *group_cols,
        F.struct("siguiente_cana", "siguiente_azucar", "tendencia_cana").alias("pronostico"),
    )
    if group_cols:
        told = record.join(forecast, list(group_cols), "left")
    else:
        told = record.withColumn("pronostico", forecast.scalar())
    return told.select(
        *group_cols,
        sentence("Y = %.4f + %.6f * X", b0, b1).alias("ecuacion"),
        sentence("Por cada ton de cana molida, se producen %.4f ton de azucar", b1).alias(
            "interpretacion_coeficiente"
        ),
        sentence(
            "El modelo explica el %.2f%% de la variabilidad en la produccion de azucar", r2 * 100
        ).alias("r2_interpretacion"),
        "pronostico",
    )


def interpretation_figures(
    record: DataFrame,
    ahead: DataFrame,
    summary: DataFrame,
    group_cols: Sequence[str] = (),
) -> DataFrame:
    """The numbers behind the interpretation: fit, next season, trend in percent, series summary."""
    ahead = ahead.select(
        *group_cols,
        "siguiente_cana",
        "siguiente_azucar",
        (F.col("tendencia_cana") * 100 - 100).alias("tendencia_pct"),
    )
    parts = {"_ahead": ahead, "_series": summary}
    figures = record.withColumn("r2_pct", F.col("test_r2") * 100)
    for name, part in parts.items():
        values = [c for c in part.columns if c not in group_cols]
        figures = attach(figures, part, values, name, group_cols)
    return figures.select(
        *group_cols, *record.drop(*group_cols).columns, "r2_pct", "_ahead.*", "_series.*"
    )
