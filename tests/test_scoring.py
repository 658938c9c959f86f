import math
import random

import pytest
from pyspark.sql import functions as F

from trapiche.config import DEFAULT_SPEC as SPEC
from trapiche.operators import regression as R
from trapiche.operators import scoring as S

XY = f"{SPEC.net} double, {SPEC.output} double"
# t(0.975, 18)
T18 = 2.10092204024104


@pytest.fixture
def data(table):
    rng = random.Random(3)
    return table([(float(x), 0.5 * x - 40 + rng.gauss(0, 5)) for x in range(100, 300, 10)], XY)


def expected(stats, x, leading):
    return T18 * math.sqrt(stats["MSE"] * (leading + 1 / stats["n"] + (x - stats["x_mean"]) ** 2 / stats["sxx"]))


def test_prediction_interval_clamps_before_and_after(data, table):
    stats = R.inference(R.fit(data))
    s = stats.first()
    new = table([(-500.0,), (0.0,), (90.0,), (200.0,)], f"{SPEC.net} double")
    rows = S.prediction_interval(new, stats).orderBy(SPEC.net).collect()
    for row in rows:
        x = row[SPEC.net]
        pred = max(0.0, s["b0"] + s["b1"] * x)
        margin = expected(s, x, 1)
        assert row["pred"] == pytest.approx(pred)
        assert row["lower"] == pytest.approx(max(0.0, pred - margin))
        assert row["upper"] == pytest.approx(max(0.0, pred + margin))
        assert 0 <= row["lower"] <= row["upper"] and row["conf_level"] == 0.95
    assert rows[0]["pred"] == 0.0 and rows[0]["upper"] > 0


def test_other_alpha_widens(data):
    stats = R.inference(R.fit(data))
    base = S.prediction_interval(data, stats).agg(F.sum(F.col("upper") - F.col("lower"))).first()[0]
    wide = S.prediction_interval(data, stats, alpha=0.01)
    assert wide.agg(F.sum(F.col("upper") - F.col("lower"))).first()[0] > base
    assert wide.first()["conf_level"] == 0.99
    # Statistics made for another alpha keep it.
    kept = S.prediction_interval(data, R.inference(R.fit(data), alpha=0.01))
    assert kept.agg(F.max("upper")).first() == wide.agg(F.max("upper")).first()


def test_confidence_band_is_not_clamped(data, table):
    model = R.fit(data)
    s = R.inference(model).first()
    row = S.confidence_band(table([(0.0,)], f"{SPEC.net} double"), model, R.inference(model)).first()
    assert row["y_hat"] == pytest.approx(s["b0"]) and row["y_hat"] < 0
    assert row["band_lower"] == pytest.approx(s["b0"] - expected(s, 0.0, 0))
    assert row["band_upper"] == pytest.approx(s["b0"] + expected(s, 0.0, 0))


def test_unusable_model_gives_nulls(data, table):
    stats = R.inference(R.fit(table([(1.0, 2.0)], XY)))
    row = S.prediction_interval(data, stats).first()
    assert (row["pred"], row["se"], row["lower"], row["upper"]) == (None,) * 4


def test_grid(data):
    grid = [r[SPEC.net] for r in S.line_grid(data).orderBy("step").collect()]
    assert len(grid) == 100 and grid[0] == 100.0 and grid[-1] == 290.0
    wide = [r[SPEC.net] for r in S.line_grid(data, widen=True).orderBy("step").collect()]
    assert wide[0] == 80.0 and wide[-1] == pytest.approx(319.0)
    assert S.line_grid(data.where("false")).count() == 0


def test_what_if(data, table):
    model = R.fit(data, where=F.col(SPEC.net) > 150)
    stats = R.inference(R.fit(data))
    rows = S.what_if(table([(0.0,), (-3.0,), (250.0,)], "cana double"), model, stats, "cana").collect()
    by = {r["cana"]: r for r in rows}
    assert len(rows) == 3 and [r["pred"] for r in rows if r["cana"] == 0] == [0.0, 0.0]
    m, s = model.first(), stats.first()
    point = m["b0"] + m["b1"] * 250
    assert by[250.0]["pred"] == pytest.approx(point)
    assert by[250.0]["rendimiento"] == pytest.approx(point / 250 * 100)
    # The interval is centred on the other fit.
    middle = (by[250.0]["lower"] + by[250.0]["upper"]) / 2
    assert middle == pytest.approx(s["b0"] + s["b1"] * 250)


def bins(df, **options):
    return [tuple(r) for r in S.histogram(df, "v", **options).orderBy("bin").select("bin_low", "count").collect()]


def test_histogram(table):
    df = table([(float(v),) for v in (0, 1, 1, 2, 9, 10)] + [(None,)], "v double")
    got = bins(df, bins=5)
    assert [c for _, c in got] == [3, 1, 0, 0, 2]
    assert [low for low, _ in got] == pytest.approx([0, 2, 4, 6, 8])


def test_histogram_without_spread_and_empty(table):
    flat = bins(table([(3.0,)] * 4, "v double"), bins=4)
    assert [c for _, c in flat] == [0, 0, 4, 0] and flat[0][0] == 2.5
    assert bins(table([], "v double")) == []


def test_histogram_per_group(table):
    df = table([("a", 0.0), ("a", 4.0), ("b", 7.0), ("b", 9.0), ("b", 9.0)], "g string, v double")
    rows = S.histogram(df, "v", 2, ["g"]).orderBy("g", "bin").collect()
    assert [(r["g"], r["count"]) for r in rows] == [("a", 1), ("a", 1), ("b", 1), ("b", 2)]


def test_actual_vs_predicted(data):
    table = S.actual_vs_predicted(R.score(data, R.fit(data)), [SPEC.net])
    assert table.columns == [SPEC.net, SPEC.output, "y_hat"] and table.count() == 20
