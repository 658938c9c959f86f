import datetime as dt
import math

import pytest

from golden import B0, B1, MEAN_RATIO, NEXT_CANE, NEXT_SUGAR, SUMS, SUMS_SCHEMA
from trapiche.config import DEFAULT_SPEC as SPEC
from trapiche.operators import forecast as P
from trapiche.operators import regression as R
from trapiche.operators import series

STATS = dict(b0=15000.0, b1=0.1, n=535, x_mean=4e5, sxx=5e13, MSE=1e9, t_crit=1.9644, alpha=0.05)
STATS_SCHEMA = "b0 double, b1 double, n long, x_mean double, sxx double, MSE double, t_crit double, alpha double"


@pytest.fixture
def seasons(table):
    return table(SUMS, SUMS_SCHEMA)


@pytest.fixture
def model(table):
    return table([(B0, B1)], "b0 double, b1 double")


@pytest.fixture
def stats(table):
    return table([tuple(STATS.values())], STATS_SCHEMA)


def test_published_next_season(seasons, model):
    row = P.forecast_next_season(seasons, model).first()
    assert row["zafra"] == "2026-2027"
    assert row["siguiente_cana"] == pytest.approx(NEXT_CANE, rel=1e-9)
    assert row["siguiente_azucar"] == pytest.approx(NEXT_SUGAR, rel=1e-9)
    assert row["tendencia_cana"] == pytest.approx(MEAN_RATIO, rel=1e-9)


def test_history_then_forecast(seasons, model):
    rows = P.history_with_forecast(seasons, P.forecast_next_season(seasons, model)).orderBy("zafra").collect()
    assert [r["tipo"] for r in rows] == ["real"] * 11 + ["pronostico"]
    assert rows[-1][SPEC.net] == pytest.approx(NEXT_CANE)


def test_published_interpretation(seasons, model, table):
    record = table([(B1, B0, 0.7683628560235957)], "coeficiente_B1 double, intercepto_B0 double, test_r2 double")
    ahead = P.forecast_next_season(seasons, model)
    row = P.interpretation(record, ahead).first()
    assert row["ecuacion"] == "Y = 18791.1719 + 0.099520 * X"
    assert row["interpretacion_coeficiente"] == "Por cada ton de cana molida, se producen 0.0995 ton de azucar"
    assert row["r2_interpretacion"] == (
        "El modelo explica el 76.84% de la variabilidad en la produccion de azucar"
    )
    assert row["pronostico"]["siguiente_azucar"] == pytest.approx(NEXT_SUGAR)
    figures = P.interpretation_figures(record, ahead, series.series_summary(seasons)).first()
    assert figures["tendencia_pct"] == pytest.approx(-9.46541, abs=1e-5)
    assert figures["zafra_maximo"] == "2018-2019" and figures["r2_pct"] == pytest.approx(76.83628560)


def brute(rows, as_of, s):
    """The 24 months by hand: rows are (label, cane, sugar) in season order."""
    top = max(r[2] for r in rows)
    whole = [r for r in rows if r[2] > top * 0.1] or rows
    cane = [r[1] for r in whole]
    base = sum(cane[-3:]) / 3 if len(cane) >= 3 else cane[-1]
    rate = sum(b / a for a, b in zip(cane, cane[1:])) / (len(cane) - 1) if len(cane) >= 3 else 1.02
    first_year = max(int(whole[-1][0][5:]), as_of.year)
    table = []
    for i in range(24):
        month, year = (as_of.month - 1 + i) % 12 + 1, first_year + (as_of.month - 1 + i) // 12
        x = base * rate ** ((i + 1) / 12) / 12 * (1 + 0.4 * math.sin(math.pi * (month - 2) / 6))
        pred = max(0, s["b0"] + s["b1"] * x)
        margin = s["t_crit"] * math.sqrt(s["MSE"] * (1 + 1 / s["n"] + (x - s["x_mean"]) ** 2 / s["sxx"]))
        figures = (x, B0 + B1 * x, max(0, pred - margin), max(0, pred + margin))
        table.append((f"{year}-{month:02d}", month, year, *[round(v, 0) for v in figures]))
    return table


@pytest.mark.parametrize("keep", [11, 10, 3, 2, 1])
@pytest.mark.parametrize("as_of", [dt.date(2026, 7, 1), dt.date(2031, 12, 31), dt.date(2012, 1, 1)])
def test_24_months(table, model, stats, keep, as_of):
    used = SUMS[-keep:] if keep != 10 else SUMS[:10]
    got = P.forecast_months(table(used, SUMS_SCHEMA), model, stats, as_of)
    rows = sorted((tuple(r) for r in got.collect()), key=lambda r: (r[2], r[1]))
    assert got.columns[:3] == ["Periodo", "Mes", "Anio"]
    expected = brute([(r[0], r[2], r[4]) for r in used], as_of, STATS)
    for mine, theirs in zip(rows, expected, strict=True):
        assert mine[:3] == theirs[:3]
        assert mine[3:] == pytest.approx(theirs[3:], abs=1.0)
    total = P.forecast_total(got).first()[0]
    assert total == pytest.approx(sum(r[4] for r in expected), abs=24)


def test_display_headings(seasons, model, stats):
    shown = P.forecast_display(P.forecast_months(seasons, model, stats, dt.date(2026, 1, 1)))
    assert shown.columns == [
        "Periodo", "Cana Molida (ton)", "Azucar Prod. (ton)", "IC Inf. 95%", "IC Sup. 95%",
    ]
    assert shown.count() == 24


def test_groups_equal_single_runs(table, model, stats):
    rows = [("a", *r) for r in SUMS] + [("b", r[0], *[v / 3 for v in r[1:]]) for r in SUMS[:4]]
    both = table(rows, "ingenio string, " + SUMS_SCHEMA)
    day, by = dt.date(2026, 5, 1), ["ingenio"]
    got = P.forecast_months(both, model, stats, day, group_cols=by)
    alone = P.forecast_months(table(SUMS, SUMS_SCHEMA), model, stats, day)
    assert got.where("ingenio = 'a'").drop("ingenio").exceptAll(alone).count() == 0
    assert got.count() == 48
    # Models per group are joined; a group without a model keeps its rows.
    own = R.fit(both.where("ingenio = 'b'"), group_cols=by)
    ahead = P.forecast_next_season(both, own, by)
    found = {r["ingenio"]: r for r in ahead.collect()}
    assert found["a"]["siguiente_azucar"] is None and found["b"]["siguiente_azucar"] is not None
    told = P.interpretation(
        own.selectExpr("ingenio", "b1 AS coeficiente_B1", "b0 AS intercepto_B0", "0.5D AS test_r2"), ahead, by
    )
    assert told.count() == 1


def test_empty_series(table, model, stats):
    none = table([], SUMS_SCHEMA)
    assert P.forecast_months(none, model, stats, dt.date(2026, 1, 1)).count() == 0
    assert P.forecast_next_season(none, model).count() == 0
