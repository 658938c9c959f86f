"""Moments as data: stored rows that merge into the model of any selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trapiche.config import DEFAULT_SPEC, FeedSpec
from trapiche.operators.regression import attach

MOMENTS = ("n", "x_mean", "y_mean", "sxx", "syy", "sxy")


def moments_schema(spec: FeedSpec = DEFAULT_SPEC) -> T.StructType:
    names = [T.StructField(c, T.StringType()) for c in (spec.producer, spec.season)]
    figures = [T.StructField(c, T.DoubleType()) for c in MOMENTS[1:]]
    return T.StructType([*names, T.StructField("n", T.LongType()), *figures])


def moments(
    df: DataFrame,
    by: Sequence[str],
    x: str | None = None,
    y: str | None = None,
    spec: FeedSpec = DEFAULT_SPEC,
) -> DataFrame:
    """One row per group: count, means, and sums of squares and products about the means.

    Rows without x or y are not counted; a group of nothing else has no row.
    """
    xs, ys = F.col(x or spec.net).cast("double"), F.col(y or spec.output).cast("double")
    rows = df.groupBy(*by).agg(
        F.regr_count(ys, xs).alias("n"),
        F.regr_avgx(ys, xs).alias("x_mean"),
        F.regr_avgy(ys, xs).alias("y_mean"),
        F.regr_sxx(ys, xs).alias("sxx"),
        F.regr_syy(ys, xs).alias("syy"),
        F.regr_sxy(ys, xs).alias("sxy"),
    )
    return rows.where("n > 0")


def merge_moments(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Moments of the union of the rows' groups.

    The squares about the common mean are those about each row's own mean plus n times the
    squared distance of the two means; distances are taken before they are squared, so means
    far from zero lose no digits. Two small aggregates over stored rows, whatever the size of
    the table they come from. Without `by` no rows give one row of no count, as a fit does.
    """
    n = F.sum("n")
    means = rows.groupBy(*by).agg(
        F.coalesce(n, F.lit(0)).alias("n"),
        (F.sum(F.col("n") * F.col("x_mean")) / n).alias("x_mean"),
        (F.sum(F.col("n") * F.col("y_mean")) / n).alias("y_mean"),
    )
    held = means.select(*by, F.col("x_mean").alias("to_x"), F.col("y_mean").alias("to_y"))
    apart = attach(rows, held, ["to_x", "to_y"], "_mean", by)
    dx, dy = F.col("x_mean") - F.col("_mean.to_x"), F.col("y_mean") - F.col("_mean.to_y")
    squares = apart.groupBy(*by).agg(
        F.sum(F.col("sxx") + F.col("n") * dx * dx).alias("sxx"),
        F.sum(F.col("syy") + F.col("n") * dy * dy).alias("syy"),
        F.sum(F.col("sxy") + F.col("n") * dx * dy).alias("sxy"),
    )
    merged = attach(means, squares, ["sxx", "syy", "sxy"], "_about", by)
    return merged.select(*by, *MOMENTS[:3], *[F.col(f"_about.{c}").alias(c) for c in MOMENTS[3:]])


def fit_moments(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Model rows from stored moments, in the columns that `regression.fit` gives."""
    sloped = merge_moments(rows, by).withColumn(
        "b1", F.when(F.col("sxx") > 0, F.col("sxy") / F.col("sxx"))
    )
    return sloped.withColumn("b0", F.col("y_mean") - F.col("b1") * F.col("x_mean"))
