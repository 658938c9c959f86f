"""Latest snapshot of cumulative reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trapiche.config import DEFAULT_SPEC, FeedSpec
from trapiche.functions.numbers import number_or_zero


def latest_snapshot(
    df: DataFrame, spec: FeedSpec = DEFAULT_SPEC, input_order: Sequence[str] = ()
) -> DataFrame:
    """One row per producer and season: the one with the highest period.

    `input_order` names the columns that give the position of a row in its input; the
    first of several rows with the same period wins. Without it periods must be unique
    within a producer and season. Those columns and the period are dropped.

    `row_number() = 1` lets Spark drop all but one row per key in every map task
    (WindowGroupLimit), so a key that holds most of the input shuffles one row per task.
    """
    order_columns = [c for c in input_order if c in df.columns]
    latest = latest_rows(df, (spec.producer, spec.season), spec, order_columns)
    return latest.drop(spec.period, *order_columns)


def latest_rows(
    df: DataFrame,
    keys: Sequence[str],
    spec: FeedSpec = DEFAULT_SPEC,
    input_order: Sequence[str] = (),
) -> DataFrame:
    """The row with the highest period of every key, with all its columns.

    Applied per file first and over all files then, it gives the same rows as at once.
    """
    if spec.period not in df.columns:
        return df
    if isinstance(df.schema[spec.period].dataType, T.StringType):
        period = number_or_zero(F.col(spec.period))
    else:
        period = F.coalesce(F.col(spec.period).cast("double"), F.lit(0.0))
    latest_first = Window.partitionBy(*keys).orderBy(
        period.desc(), *[F.col(c) for c in input_order]
    )
    ranked = df.withColumn("_rank", F.row_number().over(latest_first))
    return ranked.where(F.col("_rank") == 1).drop("_rank")
