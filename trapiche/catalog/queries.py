"""One query per operator of the survey, over the panel derived from `lineitem`.

Results are rounded where they are floating point, so that they do not depend on the
order in which partitions are added up.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trapiche.catalog.panel import text_panel, weekly_panel
from trapiche.config import DEFAULT_SPEC as SPEC
from trapiche.functions.numbers import missing_to_null
from trapiche.operators import (
    conform,
    filters,
    forecast,
    kpi,
    regression,
    rollup,
    scoring,
    series,
    sketches,
)
from trapiche.operators.derive import derive_yields, scale_columns, with_start_year
from trapiche.operators.moments import fit_moments, moments
from trapiche.operators.snapshot import latest_snapshot
from trapiche.plans.dashboard import (
    DashboardState,
    filtered_band,
    filtered_parity,
    filtered_top,
    load_state,
)
from trapiche.plans import incremental
from trapiche.plans.etl import run_etl
from trapiche.plans.modelling import run_model
from trapiche.sinks.writers import store, work_folder, write_csv, write_model, write_record
from trapiche.sources import tables
from trapiche.sources.feeds import (
    drop_unreadable_files,
    merge_aliases,
    normalize_columns,
    read_feeds,
)

Query = Callable[[SparkSession, str], DataFrame]

KEYS = (SPEC.producer, SPEC.season)
AS_OF = dt.date(2002, 3, 15)
ONE_SEASON, ONE_PRODUCER = "1997-1998", "7"
# Seasons of the test tables; the default range of the library lies later.
WIDE = replace(SPEC, first_season="1990-1991", last_season="2009-2010")
NARROW = replace(SPEC, first_season="1995-1996", last_season="1999-2000")


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weekly_panel(spark, sf_dir)


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_snapshot(panel(spark, sf_dir))


def detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_yields(latest(spark, sf_dir))


def seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.season_rollup(latest(spark, sf_dir))


def stored_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot's cane and output, written once for queries that read it several times.

    Each of their branches needs other columns of it, so they could not share a shuffle and
    would each read the lines again.
    """
    return store(latest(spark, sf_dir).select(*KEYS, SPEC.net, SPEC.output))


def stored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regression.with_split(stored_snapshot(spark, sf_dir), KEYS)


def season_line(rows: DataFrame, *group_cols: str) -> DataFrame:
    """The season series that forecasts start from."""
    return rollup.season_sums(rows, measures=(SPEC.net, SPEC.output), group_cols=group_cols)


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = latest(spark, sf_dir).select(*KEYS, SPEC.net, SPEC.output)
    return regression.with_split(rows, KEYS)


def trained(rows: DataFrame) -> DataFrame:
    return regression.fit(rows, where=~F.col("is_test"))


def full_stats(rows: DataFrame) -> DataFrame:
    return regression.inference(regression.fit(rows))


def rounded(df: DataFrame, **places: int) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), p) for c, p in places.items()})


def stepped(df: DataFrame, **places: int) -> DataFrame:
    """Ratios to a number of places by plain arithmetic, so that ties fall alike in any engine."""
    return df.withColumns(
        {c: F.floor(F.col(c) * 10.0**p + 0.5).cast("double") / 10.0**p for c, p in places.items()}
    )


def in_units(df: DataFrame, **units: float) -> DataFrame:
    """Large figures in a larger unit, to nine digits or so."""
    return df.withColumns({c: F.round(F.col(c) / unit, 3) for c, unit in units.items()})


MEASURES = {m: 2 for m in SPEC.summed} | {SPEC.gross: 4}
SEASON_PLACES = MEASURES | {SPEC.growth: 4}
YIELD_PLACES = {SPEC.season_yield: 4, SPEC.season_field_yield: 4}


def rounded_seasons(df: DataFrame) -> DataFrame:
    return stepped(rounded(df, **SEASON_PLACES), **YIELD_PLACES)


def rounded_detail(df: DataFrame) -> DataFrame:
    return stepped(rounded(df, **MEASURES), **{SPEC.industrial_yield: 4, SPEC.extraction: 4})


# Sources, conformance, snapshot


def q_panel(spark, sf_dir):
    return rounded(panel(spark, sf_dir), **MEASURES)


def q_latest_snapshot(spark, sf_dir):
    return rounded(latest(spark, sf_dir), **MEASURES)


def q_detail_derived(spark, sf_dir):
    return rounded_detail(detail(spark, sf_dir))


def q_season_range(spark, sf_dir):
    kept = conform.keep_season_range(panel(spark, sf_dir), NARROW)
    return rounded(latest_snapshot(kept), **MEASURES)


def _named_producers(df: DataFrame) -> DataFrame:
    """Producer names that are not numbers, so that the type decision keeps them as text."""
    return df.withColumn(SPEC.producer, F.concat(F.lit("M"), F.col(SPEC.producer)))


def _dirty_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text panel with missing, unparsable and padded cells, by week."""
    text = _named_producers(text_panel(panel(spark, sf_dir)))
    week = F.col(SPEC.period).cast("int")
    net, output = F.col(SPEC.net), F.col(SPEC.output)

    def cells(value: Column, *cases: tuple[Column, str]) -> Column:
        for condition, spelling in cases:
            value = F.when(condition, F.lit(spelling)).otherwise(value)
        return missing_to_null(value)

    return text.withColumns(
        {
            SPEC.net: cells(F.concat(F.lit(" "), net), (week % 5 == 0, "NA"), (week % 7 == 0, "-")),
            SPEC.output: cells(output, (week % 4 == 0, "1,234"), (week % 6 == 0, "NaN")),
            SPEC.area: cells(F.col(SPEC.area), (week % 9 == 0, "")),
            # About a third and about two thirds of the cells of these parse.
            "rendimiento_campo": cells(F.lit("n/d"), (week % 3 == 0, "1e2")),
            "rendimiento_fabrica": cells(F.lit("11.5"), (week % 3 == 0, "n/d")),
        }
    )


def q_conform_types(spark, sf_dir):
    # Stored, because deciding the types and casting are two passes.
    kept = store(conform.keep_columns(_dirty_feed(spark, sf_dir), SPEC.kept))
    return rounded(conform.conform_types(kept), **MEASURES, semana=0, rendimiento_fabrica=2)


def _two_headers(text: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The feed cut in two: canonical names, and old names in other case and order."""
    later = F.substring(SPEC.season, 1, 4).cast("int") % 2 == 1
    old = {new: name for name, new in SPEC.aliases.items()}
    renamed = text.where(later).withColumnsRenamed(
        {c: old.get(c, c).upper().replace("_", " ") for c in text.columns}
    )
    return text.where(~later), renamed.select(*reversed(renamed.columns))


def q_alias_union(spark, sf_dir):
    text = text_panel(panel(spark, sf_dir))
    parts = [merge_aliases(normalize_columns(p), SPEC.aliases) for p in _two_headers(text)]
    union = parts[0].unionByName(parts[1].withColumn("extra", F.lit("x")), allowMissingColumns=True)
    return conform.keep_columns(union, SPEC.kept)


def _raw_folder(spark: SparkSession, sf_dir: str) -> str:
    """The panel as CSV feeds with two kinds of header, in the shared work folder."""
    folder = work_folder(spark)
    text = store(_named_producers(text_panel(panel(spark, sf_dir))), f"{folder}/text")
    first, second = _two_headers(text)
    write_csv(first, f"{folder}/raw/a")
    write_csv(second, f"{folder}/raw/b")
    return f"{folder}/raw/*"


def q_csv_feeds(spark, sf_dir):
    feeds = read_feeds(spark, _raw_folder(spark, sf_dir))
    return conform.keep_columns(feeds, SPEC.kept)


def q_feed_etl(spark, sf_dir):
    out = work_folder(spark)
    result = run_etl(spark, _raw_folder(spark, sf_dir), out, WIDE, database=None)
    stored, _ = tables.read_processed(spark, result.loaded.season_csv, fmt="csv", spec=WIDE)
    return rounded_seasons(stored)


def _weekly_folder(spark: SparkSession, sf_dir: str) -> tuple[str, Callable[[int], None]]:
    """Feeds in two steps: the second one corrects some files and adds others."""
    folder = work_folder(spark)
    text = store(_named_producers(text_panel(panel(spark, sf_dir))), f"{folder}/text")
    first, second = _two_headers(text)
    early = F.col(SPEC.season) < "1998"

    def step(number: int) -> None:
        if number == 1:
            # An early report of the first file: every other week is still missing.
            write_csv(first.where(f"{SPEC.period} % 2 = 1"), f"{folder}/raw/a")
            write_csv(second.where(early), f"{folder}/raw/b")
        else:
            write_csv(first, f"{folder}/raw/a")
            write_csv(second.where(~early), f"{folder}/raw/c")

    return f"{folder}/raw/*", step


def _updated(spark: SparkSession, sf_dir: str) -> str:
    """Root of tables that two runs brought up to date, the second reading what changed."""
    raw, step = _weekly_folder(spark, sf_dir)
    root = work_folder(spark)
    for number in (1, 2):
        step(number)
        incremental.update_tables(spark, raw, root, WIDE)
    return root


def q_incremental_seasons(spark, sf_dir):
    found = incremental.published(spark, _updated(spark, sf_dir), incremental.SEASONS, WIDE)
    return rounded_seasons(found)


def q_incremental_detail(spark, sf_dir):
    found = incremental.published(spark, _updated(spark, sf_dir), incremental.DETAIL, WIDE)
    return rounded_detail(found.drop(*SPEC.reported_yields))


def q_feed_folders(spark, sf_dir):
    """Feeds of equal base names in several folders, one of them unreadable."""
    folder = _raw_folder(spark, sf_dir).removesuffix("/*")
    broken = spark.createDataFrame([("ingenio,zafra",), ("X,1997-1998,more",)], "value string")
    broken.coalesce(1).write.text(f"{folder}/c")
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for below in "abc":
        parts = files.globStatus(path(f"{folder}/{below}/part-*"))
        for number, part in enumerate(sorted(p.getPath().toString() for p in parts)):
            files.rename(path(part), path(f"{folder}/{below}/feed-{number}.csv"))
    feeds = store(read_feeds(spark, f"{folder}/*"))
    return conform.keep_columns(drop_unreadable_files(feeds), SPEC.kept)


def _odd_producers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text panel with producers that need quoting or look like numbers."""
    name, even = F.col(SPEC.producer), F.col(SPEC.producer).cast("int") % 2 == 0
    odd = F.format_string('San "%s", Norte', name)
    return text_panel(panel(spark, sf_dir)).withColumn(
        SPEC.producer, F.when(even, name).otherwise(odd)
    )


def q_detail_csv(spark, sf_dir):
    """The detail of a whole run as CSV, read back; its feeds have no reported yields."""
    out = work_folder(spark)
    write_csv(_odd_producers(spark, sf_dir), f"{out}/raw")
    done = run_etl(spark, f"{out}/raw", out, WIDE, detail_csv=True)
    _, found = tables.read_processed(
        spark, done.loaded.season_csv, done.loaded.detail_csv, WIDE, "csv"
    )
    return rounded_detail(found)


def q_detail_table(spark, sf_dir):
    """The partitioned detail of a whole run, read back; its feeds have reported yields."""
    out = work_folder(spark)
    reported = {c: F.lit("11.5") for c in SPEC.reported_yields}
    write_csv(_odd_producers(spark, sf_dir).withColumns(reported), f"{out}/raw")
    run_etl(spark, f"{out}/raw", out, WIDE)
    _, found = tables.read_processed(spark, f"{out}/seasons", f"{out}/detail", WIDE)
    return rounded_detail(found)


# Roll-up, filters, figures


def q_annual_rollup(spark, sf_dir):
    return rounded_seasons(seasons(spark, sf_dir))


def q_mill_rollup(spark, sf_dir):
    by_mill = rollup.season_rollup(latest(spark, sf_dir), group_cols=[SPEC.producer], first_growth=None)
    return rounded_seasons(by_mill)


def q_filter_season_mill(spark, sf_dir):
    chosen = filters.select_season_producer(detail(spark, sf_dir), ONE_SEASON, ONE_PRODUCER)
    return rounded(chosen.select(*KEYS, SPEC.net, SPEC.output), **{SPEC.net: 2, SPEC.output: 2})


def q_column_filter(spark, sf_dir):
    grid = filters.filter_columns(
        latest(spark, sf_dir).select(*KEYS, SPEC.net),
        contains={SPEC.season: "1998"},
        between={SPEC.net: (1500.0, 2500.0)},
    )
    return rounded(grid, **{SPEC.net: 2})


def q_complete_seasons(spark, sf_dir):
    kept = filters.complete_seasons(seasons(spark, sf_dir))
    return rounded(kept.select(SPEC.season, SPEC.output), **{SPEC.output: 2})


def q_profile(spark, sf_dir):
    report = kpi.profile(detail(spark, sf_dir))
    return report.withColumn("columnas", F.array_join("columnas", ","))


def _deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order, producer and season of every delivery."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(
        "l_orderkey AS pedido",
        f"l_suppkey AS {SPEC.producer}",
        "year(l_shipdate) - IF(month(l_shipdate) < 10, 1, 0) AS start",
    )
    season = f"concat(start, '-', start + 1) AS {SPEC.season}"
    return lines.selectExpr("pedido", SPEC.producer, season)


def _sketches_beside_exact(spark: SparkSession, sf_dir: str, by: list[str], chosen) -> DataFrame:
    """Exact counts of a selection, and whether those of stored sketches hold them."""
    counted = ["pedido", SPEC.producer]
    rows = _deliveries(spark, sf_dir)
    stored = store(sketches.distinct_sketches(rows, counted, [SPEC.season]))
    told = sketches.distinct_counts(chosen(stored), counted, by).withColumnRenamed("n_rows", "told")
    exact = chosen(rows).groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        *[F.count_distinct(c).alias(f"n_{c}") for c in counted],
    )
    if by:
        both = exact.join(told, by)
    else:
        both = exact.withColumn("_told", told.select(F.struct("*")).scalar()).select("*", "_told.*")
    within = [
        F.col(f"n_{c}").between(F.col(f"{c}_low"), F.col(f"{c}_high")).alias(f"{c}_within")
        for c in counted
    ]
    same = (F.col("n_rows") == F.col("told")).alias("rows_equal")
    return both.select(*by, "n_rows", *[f"n_{c}" for c in counted], same, *within)


def q_sketch_season_counts(spark, sf_dir):
    """Distinct orders and producers of each season, exact and within the stated error."""
    return _sketches_beside_exact(spark, sf_dir, [SPEC.season], lambda rows: rows)


def q_sketch_filtered_counts(spark, sf_dir):
    """The same over a choice of seasons: sketches are united without reading deliveries."""
    seasons = F.col(SPEC.season).isin("1994-1995", "1995-1996", "1996-1997")
    return _sketches_beside_exact(spark, sf_dir, [], lambda rows: rows.where(seasons))


def q_kpi_total(spark, sf_dir):
    return rounded(kpi.total_output(seasons(spark, sf_dir)), produccion_total=2)


def q_kpi_yield(spark, sf_dir):
    chosen = filters.select_season_producer(latest(spark, sf_dir), season=ONE_SEASON)
    milled = filters.positive_only(chosen, SPEC.net)
    return rounded(kpi.weighted_yield(milled), rendimiento=4)


def q_kpi_empty(spark, sf_dir):
    none = filters.select_season_producer(latest(spark, sf_dir), season="no such season")
    total = kpi.total_output(rollup.season_sums(none)).select("produccion_total", "n_zafras")
    return total.withColumn("rendimiento", kpi.weighted_yield(none).scalar())


def q_top_mills(spark, sf_dir):
    top = kpi.top_producers(latest(spark, sf_dir))
    return rounded(scale_columns(top, {SPEC.output: 1e3}), **{SPEC.output: 4})


def q_preview(spark, sf_dir):
    return kpi.preview(detail(spark, sf_dir))


def q_choices(spark, sf_dir):
    rows = latest(spark, sf_dir)
    lists = [rows.select(F.lit(c).alias("lista"), F.col(c).alias("valor")).distinct() for c in KEYS]
    return lists[0].unionByName(lists[1]).orderBy("lista", "valor")


def q_season_series(spark, sf_dir):
    line = with_start_year(kpi.season_series(seasons(spark, sf_dir)))
    return rounded(line, **{SPEC.output: 6, SPEC.net: 6})


def q_series_summary(spark, sf_dir):
    return rounded(series.series_summary(seasons(spark, sf_dir)), promedio=2, minimo=2, maximo=2)


def q_growth_factor(spark, sf_dir):
    return rounded(series.growth_factor(seasons(spark, sf_dir)), growth=8)


def q_season_ratios(spark, sf_dir):
    ratios = series.with_previous_ratio(seasons(spark, sf_dir))
    return rounded(ratios.select(SPEC.season, "ratio"), ratio=8)


def q_last3_mean(spark, sf_dir):
    return rounded(series.trailing_mean(seasons(spark, sf_dir)), trailing_mean=4)


def q_data_range(spark, sf_dir):
    return rounded(series.data_range(latest(spark, sf_dir), SPEC.net, SPEC.area), low=2, high=2)


# Regression


def q_split(spark, sf_dir):
    return training_rows(spark, sf_dir).select(*KEYS, "is_test")


def q_split_exact(spark, sf_dir):
    rows = latest(spark, sf_dir).select(*KEYS)
    return regression.with_split(rows, KEYS, exact=True)


def q_split_equal_keys(spark, sf_dir):
    """Weekly rows keyed by their season alone: the season at the bound is split by lineage."""
    rows = store(weekly_panel(spark, sf_dir).select(*KEYS, SPEC.period))
    lineage = [SPEC.producer, SPEC.period]
    return regression.with_split(rows, [SPEC.season], exact=True, lineage=lineage)


MODEL_UNITS = {"sxx": 1e3, "sxy": 1e6, "syy": 1e9}


def q_ols_fit(spark, sf_dir):
    model = trained(training_rows(spark, sf_dir))
    return rounded(in_units(model, **MODEL_UNITS), x_mean=6, y_mean=3, b0=2, b1=6)


def q_mill_fit(spark, sf_dir):
    rows = latest(spark, sf_dir)
    model = regression.fit(rows, group_cols=[SPEC.producer])
    return rounded(model.select(SPEC.producer, "n", "x_mean", "b0", "b1"), x_mean=4, b0=1, b1=4)


def q_ols_stats(spark, sf_dir):
    return _flat_stats(full_stats(latest(spark, sf_dir)))


def _flat_stats(stats: DataFrame) -> DataFrame:
    flat = stats.select(
        *["n", "b0", "b1", "se_b0", "se_b1", "t_b0", "t_b1", "p_b0", "p_b1", "p_f", "R2", "R2_adj"],
        *["F_stat", "MSE", "SSE", "SSR", "SST", "t_crit"],
        *[
            F.col(f"{ci}.{end}").alias(f"{ci}_{end}")
            for ci in ("ci_b0", "ci_b1")
            for end in ("low", "high")
        ],
    )
    flat = in_units(flat, MSE=1e6, SSE=1e9, SSR=1e9, SST=1e9)
    return rounded(
        flat,
        **dict.fromkeys(("b0", "se_b0", "ci_b0_low", "ci_b0_high", "F_stat"), 2),
        **dict.fromkeys(("b1", "se_b1", "t_b0", "t_b1", "ci_b1_low", "ci_b1_high"), 5),
        **dict.fromkeys(("p_b0", "p_b1", "p_f", "R2", "R2_adj", "t_crit"), 7),
    )


def stored_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store(moments(latest(spark, sf_dir), KEYS))


def q_moments_mill_fit(spark, sf_dir):
    model = fit_moments(stored_moments(spark, sf_dir), [SPEC.producer])
    return rounded(model.select(SPEC.producer, "n", "x_mean", "b0", "b1"), x_mean=4, b0=1, b1=4)


def q_moments_ols_stats(spark, sf_dir):
    """Inference from stored moments alone."""
    return _flat_stats(regression.inference(fit_moments(stored_moments(spark, sf_dir))))


def q_ols_second_pass(spark, sf_dir):
    rows = latest(spark, sf_dir)
    model = regression.fit(rows)
    stats = regression.inference(model, squares=regression.residual_squares(rows, model))
    return rounded(in_units(stats.select("n", "SSE", "R2"), SSE=1e9), R2=8)


def scored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = training_rows(spark, sf_dir)
    model = trained(rows)
    return regression.score(rows, model), model


def q_scored(spark, sf_dir):
    table, _ = scored(spark, sf_dir)
    shown = scoring.actual_vs_predicted(table, [*KEYS, "is_test"])
    return rounded(shown, **{SPEC.output: 2, "y_hat": 2})


def q_parity_range(spark, sf_dir):
    """Ends of the line where predicted equals measured, over the test rows."""
    table, _ = scored(spark, sf_dir)
    ends = series.data_range(table, SPEC.output, "y_hat", where=F.col("is_test"))
    return rounded(ends, low=2, high=2)


METRIC_PLACES = {"coeficiente_B1": 6, "intercepto_B0": 2} | {
    f"{side}_{m}": p for side in ("train", "test") for m, p in (("mae", 2), ("rmse", 2), ("r2", 8))
}


def q_metrics(spark, sf_dir):
    return rounded(regression.metrics(*scored(spark, sf_dir)), **METRIC_PLACES)


def q_fit_metrics(spark, sf_dir):
    record = regression.fit_metrics(latest(spark, sf_dir))
    return rounded(record, **{c: METRIC_PLACES[c] for c in record.columns})


def q_kpi_model(spark, sf_dir):
    figures = kpi.model_figures(regression.metrics(*scored(spark, sf_dir)))
    return rounded(figures, test_r2=8, test_mae=2)


def q_stored_model(spark, sf_dir):
    """Model, metrics and interpretation written by the modelling plan and read back."""
    out = work_folder(spark)
    stored = store(latest(spark, sf_dir), f"{out}/detail")
    run_model(rollup.season_rollup(stored), stored, out)
    model = tables.read_model(spark, f"{out}/model")
    record = tables.read_record(spark, f"{out}/metrics", tables.METRICS_SCHEMA)
    told = tables.read_record(spark, f"{out}/interpretation", tables.INTERPRETATION_SCHEMA)
    joined = (
        record.withColumn("b1", model.select("b1").scalar())
        .withColumn("told", told.select(F.struct("ecuacion", "pronostico.siguiente_azucar")).scalar())
        .select("*", "told.*")
        .drop("told")
    )
    return rounded(joined, **METRIC_PLACES, b1=6, siguiente_azucar=1)


def q_model_table(spark, sf_dir):
    out = work_folder(spark)
    write_model(trained(training_rows(spark, sf_dir)), f"{out}/model")
    return rounded(tables.read_model(spark, f"{out}/model").select("n", "b0", "b1"), b0=2, b1=6)


def q_report(spark, sf_dir):
    out = work_folder(spark)
    write_record(kpi.profile(detail(spark, sf_dir)), f"{out}/report")
    report = spark.read.json(f"{out}/report")
    return report.withColumn("columnas", F.array_join("columnas", ","))


# Scoring


def q_residual_hist(spark, sf_dir):
    rows = training_rows(spark, sf_dir)
    table = regression.score(rows, trained(rows))
    bins = scoring.histogram(table, "residual", where=F.col("is_test"))
    return rounded(bins, bin_low=1, bin_high=1)


INTERVAL_PLACES = {"pred": 2, "se": 2, "lower": 2, "upper": 2}


def q_pred_interval(spark, sf_dir):
    rows = stored_snapshot(spark, sf_dir)
    table = scoring.prediction_interval(rows, full_stats(rows))
    return rounded(table.select(*KEYS, *INTERVAL_PLACES), **INTERVAL_PLACES)


def q_pred_interval_99(spark, sf_dir):
    rows = stored_snapshot(spark, sf_dir)
    table = scoring.prediction_interval(rows, full_stats(rows), alpha=0.01)
    return rounded(table.select(*KEYS, "lower", "upper"), lower=2, upper=2)


def q_conf_band(spark, sf_dir):
    rows = stored_rows(spark, sf_dir)
    band = scoring.confidence_band(rows, trained(rows), full_stats(rows))
    return rounded(
        band.select(*KEYS, "y_hat", "band_lower", "band_upper"), y_hat=2, band_lower=2, band_upper=2
    )


def q_line_grid(spark, sf_dir):
    rows = stored_rows(spark, sf_dir)
    line = regression.score(scoring.line_grid(rows), trained(rows))
    return rounded(line, **{SPEC.net: 4, "y_hat": 2})


def q_whatif_band(spark, sf_dir):
    rows = stored_rows(spark, sf_dir)
    grid = scoring.line_grid(rows, widen=True)
    band = scoring.confidence_band(grid, trained(rows), full_stats(rows))
    return rounded(band, **{SPEC.net: 4, "y_hat": 2, "band_lower": 2, "band_upper": 2})


def q_whatif(spark, sf_dir):
    """Half the cane of every season and producer, and none at all, as scenarios."""
    rows = stored_rows(spark, sf_dir)
    scenarios = rows.select(*KEYS, F.explode(F.array(F.lit(0.5), F.lit(0.0))).alias("share"), SPEC.net)
    scenarios = scenarios.select(*KEYS, "share", (F.col(SPEC.net) * F.col("share")).alias("cana"))
    table = scoring.what_if(scenarios, trained(rows), full_stats(rows), "cana")
    return rounded(table, cana=2, rendimiento=3, conf_level=2, **INTERVAL_PLACES)


# Forecast


def q_forecast_next(spark, sf_dir):
    rows = stored_rows(spark, sf_dir)
    ahead = forecast.forecast_next_season(season_line(rows), trained(rows))
    return rounded(ahead, siguiente_cana=3, siguiente_azucar=1, tendencia_cana=8)


def q_mill_forecast_next(spark, sf_dir):
    """Every producer's next season from its own model and its own series."""
    by = [SPEC.producer]
    rows = stored_snapshot(spark, sf_dir)
    ahead = forecast.forecast_next_season(
        season_line(rows, *by), regression.fit(rows, group_cols=by), by
    )
    return rounded(ahead, siguiente_cana=3, siguiente_azucar=0, tendencia_cana=8)


def q_history_plus_forecast(spark, sf_dir):
    rows = training_rows(spark, sf_dir)
    table = season_line(rows)
    ahead = forecast.forecast_next_season(table, trained(rows))
    return rounded(forecast.history_with_forecast(table, ahead), **{SPEC.net: 2, SPEC.output: 1})


def months(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = training_rows(spark, sf_dir)
    return forecast.forecast_months(season_line(rows), trained(rows), full_stats(rows), AS_OF)


def q_forecast_24m(spark, sf_dir):
    return months(spark, sf_dir)


def q_forecast_display(spark, sf_dir):
    return forecast.forecast_display(months(spark, sf_dir))


def q_mill_forecast_24m(spark, sf_dir):
    """24 months for every producer, from its own series, model and statistics."""
    by = [SPEC.producer]
    rows = stored_snapshot(spark, sf_dir)
    model = regression.fit(rows, group_cols=by)
    table = forecast.forecast_months(
        season_line(rows, *by), model, regression.inference(model), AS_OF, group_cols=by
    )
    return table


def q_forecast_total(spark, sf_dir):
    return forecast.forecast_total(months(spark, sf_dir))


def q_interpretation(spark, sf_dir):
    rows = stored_rows(spark, sf_dir)
    line, model = season_line(rows), trained(rows)
    table = regression.score(rows, model)
    ahead = forecast.forecast_next_season(line, model)
    told = forecast.interpretation(regression.metrics(table, model), ahead)
    flat = told.select("ecuacion", "interpretacion_coeficiente", "r2_interpretacion", "pronostico.*")
    return rounded(flat, siguiente_cana=3, siguiente_azucar=1, tendencia_cana=8)


def q_interpretation_figures(spark, sf_dir):
    rows = stored_rows(spark, sf_dir)
    line, model = season_line(rows), trained(rows)
    table = regression.score(rows, model)
    figures = forecast.interpretation_figures(
        regression.metrics(table, model),
        forecast.forecast_next_season(line, model),
        series.series_summary(line),
    )
    shown = figures.select(
        "r2_pct", "siguiente_cana", "tendencia_pct", "promedio", "zafra_minimo", "zafra_maximo"
    )
    return rounded(shown, r2_pct=6, siguiente_cana=3, tendencia_pct=6, promedio=2)


# Dashboard


def q_dashboard_state(spark, sf_dir):
    """Tables of a run without model and metrics: both come from all rows instead."""
    out = work_folder(spark)
    rows = store(detail(spark, sf_dir), f"{out}/detail")
    store(rollup.season_rollup(rows), f"{out}/seasons")
    state = load_state(spark, out)
    record = rounded(state.metrics, **{c: METRIC_PLACES[c] for c in state.metrics.columns})
    fitted = rounded(state.model.select("n", "b0", "b1"), b0=2, b1=6)
    return record.withColumn("_model", fitted.select(F.struct("*")).scalar()).select(
        *record.columns, "_model.*"
    )


def _state(spark: SparkSession, sf_dir: str) -> DashboardState:
    rows = training_rows(spark, sf_dir)
    return DashboardState(rows, None, trained(rows), full_stats(rows), None, None)


def q_filtered_band(spark, sf_dir):
    """The line over one season's range, with the model of all seasons."""
    band = filtered_band(_state(spark, sf_dir), ONE_SEASON)
    return rounded(band, **{SPEC.net: 4, "y_hat": 2, "band_lower": 2, "band_upper": 2})


def q_filtered_parity(spark, sf_dir):
    shown = filtered_parity(_state(spark, sf_dir), ONE_SEASON)
    return rounded(shown, **{SPEC.output: 2, "y_hat": 2})


def q_filtered_top(spark, sf_dir):
    top = filtered_top(_state(spark, sf_dir), ONE_SEASON)
    return rounded(top, **{SPEC.output: 2})


QUERIES: dict[str, Query] = {
    name.removeprefix("q_"): query for name, query in list(globals().items()) if name.startswith("q_")
}
