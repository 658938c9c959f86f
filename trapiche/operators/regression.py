"""One-feature least squares from mergeable moments.

A model is a row (one per group with `group_cols`). Fitting is a single partial plus
final aggregate whatever the size of the input; everything after it is arithmetic on
model rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trapiche.config import DEFAULT_SPEC, FeedSpec
from trapiche.functions.student_t import f_tail, t_critical, t_two_sided_p
from trapiche.sinks.writers import store

TEST_FRACTION = 0.2
SEED = 42
CONFIDENCE_ALPHA = 0.05
# Hash digits counted at a time, and those of a whole hash.
BUCKET_DIGITS = 3
HASH_DIGITS = 32


def split_hash(keys: Sequence[str], seed: int = SEED) -> Column:
    """Hash of the row's key: the same in every run, partitioning and engine with md5."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def with_split(
    df: DataFrame,
    keys: Sequence[str],
    test_fraction: float = TEST_FRACTION,
    seed: int = SEED,
    exact: bool = False,
    lineage: Sequence[str] | None = None,
) -> DataFrame:
    """Add the boolean `is_test`.

    By default a row is tested when its hash falls under the fraction: no job, no shuffle,
    and about the right share. With `exact` the share is ceil(fraction * rows) to the row,
    at the price of a few aggregates over stored hashes, which run here. Rows that share the
    key at the bound are told apart by `lineage` (all other columns unless given), those that
    share that too by a number they are stored with: these are rows of which any may be
    chosen. An exact split reads `df` more than once, so it must give the same rows each time.
    """
    h = split_hash(keys, seed)
    if exact:
        if lineage is None:
            lineage = [c for c in df.columns if c not in keys]
        return _exact_split(df, h, split_hash([*keys, *lineage], seed), test_fraction)
    bound = format(int(test_fraction * 2**32), "08x")
    return df.withColumn("is_test", F.substring(h, 1, 8) < bound)


def _exact_split(df: DataFrame, by_key: Column, by_row: Column, fraction: float) -> DataFrame:
    """Test the k smallest rows by (hash of the key, hash of the row), k = ceil(fraction * n)."""
    hashes = store(df.select(by_key.alias("h")))
    wanted = math.ceil(hashes.count() * fraction)
    bound, left = _bound(hashes, wanted)
    if not left:
        return df.withColumn("is_test", by_key <= bound)
    # One key holds more rows than are still wanted.
    at_bound = by_key == bound
    second, left = _bound(store(df.where(at_bound).select(by_row.alias("h"))), left)
    if not left:
        return df.withColumn("is_test", (by_key < bound) | at_bound & (by_row <= second))
    # So do rows that are alike; a stored number stays what it is in every later pass.
    number = "_number"
    while number in df.columns:
        number += "_"
    alike = at_bound & (by_row == second)
    numbered = store(df.where(alike).withColumn(number, F.monotonically_increasing_id()))
    by_number = F.md5(F.col(number).cast("string"))
    third, _ = _bound(numbered.select(by_number.alias("h")), left)
    others = df.where(~alike).withColumn(
        "is_test", (by_key < bound) | at_bound & (by_row < second)
    )
    return others.unionByName(numbered.withColumn("is_test", by_number <= third).drop(number))


def _bound(hashes: DataFrame, wanted: int) -> tuple[str, int]:
    """What the smallest `wanted` hashes do not exceed, without ranking rows.

    Rows are counted by the next few digits of the hashes that share the digits found so far,
    until a prefix holds exactly the rows that are still wanted. A count sees at most
    16**BUCKET_DIGITS buckets, and each one divides the rows left by as many. The second value
    is 0, or how many rows of the hash at the bound are wanted where it has more.
    """
    prefix = ""
    while wanted and len(prefix) < HASH_DIGITS:
        inside = hashes.where(F.startswith("h", F.lit(prefix))) if prefix else hashes
        digits = F.substring("h", len(prefix) + 1, BUCKET_DIGITS)
        for found, n in sorted(inside.groupBy(digits.alias("digits")).count().collect()):
            if wanted <= n:
                break
            wanted -= n
        prefix += found
        if wanted == n:
            # Every hash with this prefix counts: "g" follows all digits.
            return f"{prefix}g", 0
    return prefix, wanted


def fit(
    df: DataFrame,
    x: str | None = None,
    y: str | None = None,
    where: Column | None = None,
    group_cols: Sequence[str] = (),
    spec: FeedSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Model rows: moments, intercept b0 and slope b1 (null when x does not vary).

    `where` restricts the rows inside the aggregate rather than by a filter, so that a plan
    which also scores the same table can share its shuffle.
    """
    xs, ys = F.col(x or spec.net).cast("double"), F.col(y or spec.output).cast("double")
    if where is not None:
        xs, ys = F.when(where, xs), F.when(where, ys)
    moments = df.groupBy(*group_cols).agg(
        F.regr_count(ys, xs).alias("n"),
        F.regr_avgx(ys, xs).alias("x_mean"),
        F.regr_avgy(ys, xs).alias("y_mean"),
        F.regr_sxx(ys, xs).alias("sxx"),
        F.regr_syy(ys, xs).alias("syy"),
        F.regr_sxy(ys, xs).alias("sxy"),
    )
    sloped = moments.withColumn("b1", F.when(F.col("sxx") > 0, F.col("sxy") / F.col("sxx")))
    return sloped.withColumn("b0", F.col("y_mean") - F.col("b1") * F.col("x_mean"))


def attach(
    df: DataFrame, rows: DataFrame, columns: Sequence[str], name: str, group_cols: Sequence[str] = ()
) -> DataFrame:
    """Add columns of model rows to every row, as a struct.

    Model rows per group are joined on the group columns and Spark picks the join. A model
    without them is a single row: a scalar subquery, evaluated once and then a constant.
    """
    keys = [c for c in group_cols if c in rows.columns]
    packed = rows.select(*keys, F.struct(*columns).alias(name))
    if keys:
        return df.join(packed, keys, "left")
    return df.withColumn(name, packed.scalar())


def score(
    df: DataFrame,
    model: DataFrame,
    x: str | None = None,
    y: str | None = None,
    group_cols: Sequence[str] = (),
    spec: FeedSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Add `y_hat`, and `residual` where the table holds the measured value."""
    x, y = x or spec.net, y or spec.output
    scored = attach(df, model, ["b0", "b1"], "_model", group_cols).withColumn(
        "y_hat", F.col("_model.b0") + F.col("_model.b1") * F.col(x)
    )
    if y in df.columns:
        scored = scored.withColumn("residual", F.col(y) - F.col("y_hat"))
    return scored.drop("_model")


def metrics(
    scored: DataFrame,
    model: DataFrame,
    y: str | None = None,
    group_cols: Sequence[str] = (),
    spec: FeedSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Errors on the training and the test rows of a scored table, in one aggregate.

    R2 is about the mean of the rows it is measured on, so it may be negative.
    """
    test, measured, error = F.col("is_test"), F.col(y or spec.output).cast("double"), F.col("residual")

    def side(condition: Column, prefix: str) -> list[Column]:
        e, v = F.when(condition, error), F.when(condition, measured)
        spread = F.regr_syy(v, v)
        r2 = F.when(spread > 0, 1 - F.sum(e * e) / spread)
        return [
            F.avg(F.abs(e)).alias(f"{prefix}_mae"),
            F.sqrt(F.avg(e * e)).alias(f"{prefix}_rmse"),
            r2.alias(f"{prefix}_r2"),
        ]

    errors = scored.groupBy(*group_cols).agg(
        *side(~test, "train"),
        *side(test, "test"),
        F.count("*").alias("n_samples"),
        F.count(F.when(~test, 1)).alias("n_train"),
        F.count(F.when(test, 1)).alias("n_test"),
    )
    return attach(errors, model, ["b0", "b1"], "_model", group_cols).select(
        *group_cols,
        F.col("_model.b1").alias("coeficiente_B1"),
        F.col("_model.b0").alias("intercepto_B0"),
        *[f"{side}_{m}" for m in ("mae", "rmse", "r2") for side in ("train", "test")],
        "n_samples",
        "n_train",
        "n_test",
    )


def sample_metrics(
    df: DataFrame,
    model: DataFrame,
    x: str | None = None,
    y: str | None = None,
    spec: FeedSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Errors of a model on all rows of a table, as if all of them were test rows."""
    scored = score(df, model, x, y, spec=spec).withColumn("is_test", F.lit(True))
    record = metrics(scored, model, y, spec=spec)
    return record.select("coeficiente_B1", "intercepto_B0", "test_r2", "test_mae", "test_rmse")


def fit_metrics(
    df: DataFrame, x: str | None = None, y: str | None = None, spec: FeedSpec = DEFAULT_SPEC
) -> DataFrame:
    """Fit on all rows and the errors on those same rows."""
    return sample_metrics(df, fit(df, x, y, spec=spec), x, y, spec)


def inference(
    model: DataFrame,
    alpha: float = CONFIDENCE_ALPHA,
    squares: DataFrame | None = None,
    group_cols: Sequence[str] = (),
) -> DataFrame:
    """Standard errors, tests, intervals and sums of squares of fitted model rows.

    The residual sum of squares follows from the moments; near a perfect fit that
    difference cancels, and `squares`, made by `residual_squares`, supplies it instead.
    Null throughout when x does not vary or n <= 2.
    """
    usable = (F.col("n") > 2) & (F.col("sxx") > 0)
    if squares is None:
        unexplained = F.col("syy") - F.col("sxy") * F.col("sxy") / F.col("sxx")
        rows = model.withColumn("SSE", F.when(usable, F.greatest(unexplained, F.lit(0.0))))
    else:
        rows = attach(model, squares, ["SSE"], "_rss", group_cols)
        rows = rows.withColumn("SSE", F.when(usable, F.col("_rss.SSE"))).drop("_rss")
    n, dof = F.col("n").cast("double"), (F.col("n") - 2).cast("double")
    rows = rows.withColumns(
        {
            "dof": F.when(usable, dof),
            "MSE": F.when(usable, F.col("SSE") / dof),
            "SST": F.when(usable, F.col("syy")),
        }
    )
    spread = 1 / n + F.col("x_mean") * F.col("x_mean") / F.col("sxx")
    rows = rows.withColumns(
        {
            "SSR": F.col("SST") - F.col("SSE"),
            "R2": 1 - F.try_divide(F.col("SSE"), F.col("SST")),
            "se_b0": F.when(usable, F.sqrt(F.col("MSE") * spread)),
            "se_b1": F.when(usable, F.sqrt(F.col("MSE") / F.col("sxx"))),
            "alpha": F.lit(alpha),
            "t_crit": t_critical(alpha, "dof"),
        }
    )
    rows = rows.withColumns(
        {
            "R2_adj": 1 - (1 - F.col("R2")) * (n - 1) / F.col("dof"),
            "F_stat": _over_error(F.col("SSR"), F.col("MSE")),
            "t_b0": _over_error(F.col("b0"), F.col("se_b0")),
            "t_b1": _over_error(F.col("b1"), F.col("se_b1")),
        }
    )
    margin0, margin1 = F.col("t_crit") * F.col("se_b0"), F.col("t_crit") * F.col("se_b1")
    return rows.withColumns(
        {
            "p_b0": t_two_sided_p("t_b0", "dof"),
            "p_b1": t_two_sided_p("t_b1", "dof"),
            "p_f": f_tail("F_stat", "dof"),
            "ci_b0": F.struct((F.col("b0") - margin0).alias("low"), (F.col("b0") + margin0).alias("high")),
            "ci_b1": F.struct((F.col("b1") - margin1).alias("low"), (F.col("b1") + margin1).alias("high")),
        }
    )


def _over_error(value: Column, error: Column) -> Column:
    """value / error, infinite for a perfect fit."""
    unbounded = F.signum(value) * F.lit(float("inf"))
    return F.when(error > 0, value / error).when(value != 0, unbounded)


def residual_squares(
    df: DataFrame,
    model: DataFrame,
    x: str | None = None,
    y: str | None = None,
    group_cols: Sequence[str] = (),
    spec: FeedSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Sum of squared residuals of each model, from a second pass over its rows."""
    scored = score(df, model, x, y, group_cols, spec)
    return scored.groupBy(*group_cols).agg(F.sum(F.col("residual") * F.col("residual")).alias("SSE"))
