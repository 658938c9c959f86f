"""Intervals, bands, grids and residual tables around a fitted model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trapiche.config import DEFAULT_SPEC, FeedSpec
from trapiche.functions.numbers import clamp_at_zero, guarded_ratio
from trapiche.functions.student_t import t_critical
from trapiche.operators.regression import attach, score

GRID_POINTS = 100
HISTOGRAM_BINS = 25
INTERVAL_FIELDS = ("b0", "b1", "n", "x_mean", "sxx", "MSE", "t_crit", "alpha")


def _stats_for(stats: DataFrame, alpha: float | None) -> DataFrame:
    """Model rows with the critical value of this alpha; None keeps the one they carry."""
    if alpha is None:
        return stats
    return stats.withColumns({"t_crit": t_critical(alpha, "dof"), "alpha": F.lit(alpha)})


def _standard_error(s: Column, x: Column, leading: float) -> Column:
    """sqrt(MSE * (leading + 1/n + (x - mean)^2 / Sxx)); null for an unusable model."""
    away = x - s["x_mean"]
    spread = F.lit(leading) + F.try_divide(F.lit(1.0), s["n"].cast("double")) + F.try_divide(away * away, s["sxx"])
    return F.sqrt(s["MSE"] * spread)


def prediction_interval(
    df: DataFrame,
    stats: DataFrame,
    x: str | None = None,
    alpha: float | None = None,
    group_cols: Sequence[str] = (),
    spec: FeedSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Add `pred`, `se`, `lower`, `upper`, `conf_level` for a single new observation at x.

    The prediction is clamped at zero before the margin is applied, the bounds after it.
    """
    value = F.col(x or spec.net).cast("double")
    s = F.col("_stats")
    based = attach(df, _stats_for(stats, alpha), INTERVAL_FIELDS, "_stats", group_cols)
    # greatest() skips nulls: without a model the prediction must stay null, not become 0.
    line = s["b0"] + s["b1"] * value
    pred = F.when(line.isNotNull(), clamp_at_zero(line))
    based = based.withColumn("pred", pred).withColumn("se", _standard_error(s, value, 1.0))
    margin = s["t_crit"] * F.col("se")
    lower, upper = F.col("pred") - margin, F.col("pred") + margin
    return based.withColumns(
        {
            "lower": F.when(lower.isNotNull(), clamp_at_zero(lower)),
            "upper": F.when(upper.isNotNull(), clamp_at_zero(upper)),
            "conf_level": 1 - s["alpha"],
        }
    ).drop("_stats")


def confidence_band(
    df: DataFrame,
    model: DataFrame,
    stats: DataFrame,
    x: str | None = None,
    alpha: float | None = None,
    group_cols: Sequence[str] = (),
    spec: FeedSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Add `y_hat` of `model` and the band of the mean response from `stats` (not clamped)."""
    value = F.col(x or spec.net).cast("double")
    lined = score(df, model, x, group_cols=group_cols, spec=spec).drop("residual")
    based = attach(lined, _stats_for(stats, alpha), INTERVAL_FIELDS, "_stats", group_cols)
    s = F.col("_stats")
    margin = s["t_crit"] * _standard_error(s, value, 0.0)
    return based.withColumns(
        {"band_lower": F.col("y_hat") - margin, "band_upper": F.col("y_hat") + margin}
    ).drop("_stats")


def line_grid(
    df: DataFrame,
    x: str | None = None,
    points: int = GRID_POINTS,
    widen: bool = False,
    group_cols: Sequence[str] = (),
    spec: FeedSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Evenly spaced x over the data range; `widen` stretches it to [0.8 min, 1.1 max] from 0 up."""
    x = x or spec.net
    low, high = F.min(x).cast("double"), F.max(x).cast("double")
    if widen:
        low, high = clamp_at_zero(low * 0.8), high * 1.1
    ends = df.groupBy(*group_cols).agg(
        low.alias("_low"), high.alias("_high"), F.count(x).alias("_n")
    )
    steps = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("step")
    at = F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("step") / (points - 1)
    return ends.where("_n > 0").select(*group_cols, "_low", "_high", steps).select(
        *group_cols, "step", at.alias(x)
    )


def what_if(
    scenarios: DataFrame,
    model: DataFrame,
    stats: DataFrame,
    x: str,
    alpha: float | None = None,
    group_cols: Sequence[str] = (),
    spec: FeedSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Prediction for given inputs: the point from `model`, its interval from `stats`.

    Inputs that are not positive give zeros. The yield is the prediction per input in percent.
    """
    positive = F.col(x) > 0
    bounded = prediction_interval(scenarios, stats, x, alpha, group_cols, spec)
    pointed = score(bounded, model, x, group_cols=group_cols, spec=spec)

    def kept(name: str) -> Column:
        return F.when(positive, F.col(name)).otherwise(F.lit(0.0))

    return (
        pointed.withColumns(
            {
                "pred": kept("y_hat"),
                "lower": kept("lower"),
                "upper": kept("upper"),
                "se": kept("se"),
                x: F.when(positive, F.col(x)).otherwise(F.lit(0)),
            }
        )
        .withColumn("rendimiento", guarded_ratio(F.col("pred"), F.col(x), 100.0))
        .drop("y_hat", "residual")
    )


def actual_vs_predicted(
    scored: DataFrame, keys: Sequence[str] = (), spec: FeedSpec = DEFAULT_SPEC
) -> DataFrame:
    """Measured against predicted values of a scored table."""
    return scored.select(*keys, spec.output, "y_hat")


def histogram(
    df: DataFrame,
    value: str,
    bins: int = HISTOGRAM_BINS,
    group_cols: Sequence[str] = (),
    where: Column | None = None,
) -> DataFrame:
    """Counts in equal-width bins over the data range; the last bin is closed.

    A range without width is widened by half a unit each way. Empty bins are kept: counts
    are per bin before they meet the list of bins, so only bins travel.

    `where` blanks the other rows rather than filtering them, so that both passes over the
    table (range, then counts) and the fit behind it can share one shuffle.
    """
    if where is not None:
        df = df.withColumn(value, F.when(where, F.col(value)))
    present = df.where(F.col(value).isNotNull())
    low, high = F.min(value).cast("double"), F.max(value).cast("double")
    spread = present.groupBy(*group_cols).agg(low.alias("low"), high.alias("high"))
    flat = F.col("low") == F.col("high")
    half = F.when(flat, F.lit(0.5)).otherwise(F.lit(0.0))
    spread = spread.select(*group_cols, (F.col("low") - half).alias("low"), (F.col("high") + half).alias("high"))
    placed = attach(present, spread, ["low", "high"], "_range", group_cols)
    r = F.col("_range")
    index = F.floor((F.col(value) - r["low"]) / (r["high"] - r["low"]) * bins).cast("int")
    counts = (
        placed.withColumn("bin", F.least(index, F.lit(bins - 1)))
        .groupBy(*group_cols, "bin")
        .agg(F.count("*").alias("count"))
    )
    edges = spread.where(F.col("low").isNotNull()).select(
        *group_cols, "low", "high", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    width = (F.col("high") - F.col("low")) / bins
    return edges.join(counts, [*group_cols, "bin"], "left").select(
        *group_cols,
        "bin",
        (F.col("low") + width * F.col("bin")).alias("bin_low"),
        (F.col("low") + width * (F.col("bin") + 1)).alias("bin_high"),
        F.coalesce("count", F.lit(0)).cast("long").alias("count"),
    )
