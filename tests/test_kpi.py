import pytest
from pyspark.sql import functions as F

from golden import SUMS, SUMS_SCHEMA
from trapiche.config import DEFAULT_SPEC as SPEC
from trapiche.operators import filters, kpi, series

SMALL = f"ingenio string, zafra string, {SPEC.net} double, {SPEC.output} double"
ROWS = [
    ("a", "s1", 10.0, 1.0),
    ("a", "s2", 0.0, 50.0),
    ("b", "s1", 30.0, 4.0),
    ("San Luis", "s2", 20.0, 2.0),
]


@pytest.fixture
def detail(table):
    return table(ROWS, SMALL)


def test_profile(detail):
    for approximate in (False, True):
        report = kpi.profile(detail, approximate=approximate).first()
        assert tuple(report) == (4, 2, 3, ["ingenio", "zafra", SPEC.net, SPEC.output])
    assert kpi.profile(detail.drop("zafra")).first()["total_zafras"] == 0


def test_selection(detail):
    assert filters.select_season_producer(detail).count() == 4
    assert filters.select_season_producer(detail, season="s1").count() == 2
    assert filters.select_season_producer(detail, "s1", "b").count() == 1
    assert filters.select_season_producer(detail.drop("ingenio"), "s1", "b").count() == 2


def test_grid_filter(detail):
    found = filters.filter_columns(detail, {"ingenio": "SAN"}, {SPEC.net: (5, None)})
    assert [r[0] for r in found.collect()] == ["San Luis"]
    assert filters.filter_columns(detail, between={SPEC.net: (None, 10)}).count() == 2
    assert filters.filter_columns(detail).count() == 4


def test_figures(detail):
    assert tuple(kpi.total_output(detail).first()) == (57.0, 2)
    # The row without cane is left out of both sums.
    assert kpi.weighted_yield(detail).first()[0] == 7.0 / 60.0 * 100.0
    none = detail.where("false")
    assert tuple(kpi.total_output(none).first()) == (0.0, 0)
    assert kpi.weighted_yield(none).first()[0] == 0.0
    assert kpi.weighted_yield(detail.where(f"{SPEC.net} = 0")).first()[0] == 0.0


def test_model_figures(table):
    assert tuple(kpi.model_figures(table([(0.5, 2.0)], "test_r2 double, test_mae double")).first()) == (0.5, 2.0)
    assert tuple(kpi.model_figures(table([(1,)], "other int")).first()) == (None, None)


def test_top_breaks_ties_by_name(table):
    rows = [(f"m{i:02d}", "s", 1.0, 100.0 - i) for i in range(14)]
    rows += [("zz", "s", 1.0, 1.0), ("aa", "s", 1.0, 1.0), ("bb", "s", 1.0, 1.0)]
    top = kpi.top_producers(table(rows, SMALL)).collect()
    assert [r[0] for r in top] == [f"m{i:02d}" for i in range(14)] + ["aa"]


def test_preview_rounds_half_to_even(table):
    rows = [(f"m{i:03d}", "s", 0.125, 0.375) for i in range(120)]
    shown = kpi.preview(table(rows, SMALL)).collect()
    assert len(shown) == 100 and shown[0]["ingenio"] == "m000" and shown[99]["ingenio"] == "m099"
    assert (shown[0][SPEC.net], shown[0][SPEC.output]) == (0.12, 0.38)


def test_choices(detail):
    assert [r[0] for r in kpi.choices(detail, "ingenio").collect()] == ["San Luis", "a", "b"]


@pytest.fixture
def seasons(table):
    return table(SUMS, SUMS_SCHEMA)


def test_published_series(seasons):
    summary = series.series_summary(seasons).first()
    assert summary["zafra_minimo"] == "2025-2026" and summary["zafra_maximo"] == "2018-2019"
    assert summary["promedio"] == pytest.approx(56586254.48 / 11)
    whole = filters.complete_seasons(seasons)
    assert whole.count() == 10
    assert series.trailing_mean(whole).first()[0] == pytest.approx(44350181.75, abs=0.01)
    assert series.growth_factor(whole).first()[0] == pytest.approx(0.99132909, abs=1e-8)
    assert series.series_summary(whole).first()["promedio"] == pytest.approx(5602333.83, abs=0.01)
    line = kpi.season_series(seasons).collect()
    assert line[0][SPEC.output] == pytest.approx(6.117048109)


def short(table, *values):
    rows = [(f"{2000 + i}-{2001 + i}", v, v) for i, v in enumerate(values)]
    return table(rows, f"zafra string, {SPEC.net} double, {SPEC.output} double")


@pytest.mark.parametrize(
    "values, mean, growth",
    [
        ((8.0,), 8.0, 1.02),
        ((8.0, 4.0), 4.0, 1.02),
        ((8.0, 4.0, 6.0), 6.0, 1.0),
        ((1.0, 8.0, 4.0, 6.0), 6.0, (8 + 0.5 + 1.5) / 3),
        ((0.0, 8.0, 4.0, 6.0), 6.0, 1.0),
    ],
)
def test_outlook(table, values, mean, growth):
    start = series.outlook(short(table, *values)).first()
    assert start["trailing_mean"] == pytest.approx(mean)
    assert start["growth"] == pytest.approx(growth)
    assert start["last_season"] == f"{1999 + len(values)}-{2000 + len(values)}"
    assert series.trailing_mean(short(table, *values)).first()[0] == pytest.approx(mean)


def test_ties_take_the_first_season(table):
    row = series.series_summary(short(table, 5.0, 1.0, 1.0, 5.0)).first()
    assert (row["zafra_minimo"], row["zafra_maximo"]) == ("2001-2002", "2000-2001")


def test_completeness_is_strict_and_falls_back(table):
    kept = filters.complete_seasons(short(table, 100.0, 10.0, 10.1))
    assert sorted(r[SPEC.output] for r in kept.collect()) == [10.1, 100.0]
    assert filters.complete_seasons(short(table, 0.0, 0.0)).count() == 2


def test_groups_are_independent(table):
    rows = [("a", "1", 1.0, 100.0), ("a", "2", 2.0, 5.0), ("b", "1", 3.0, 5.0), ("b", "2", 6.0, 5.0)]
    df = table(rows, SMALL)
    assert filters.complete_seasons(df, group_cols=["ingenio"]).count() == 3
    ratios = {r["ingenio"]: r["growth"] for r in series.growth_factor(df, group_cols=["ingenio"]).collect()}
    assert ratios == {"a": 2.0, "b": 2.0}
    assert tuple(series.data_range(df, SPEC.net, SPEC.output).first()) == (1.0, 100.0)
    assert series.data_range(df.where(F.lit(False)), SPEC.net).first()["low"] is None
