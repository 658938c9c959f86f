import math
import random

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from golden import SUMS, SUMS_SCHEMA
from trapiche.config import DEFAULT_SPEC as SPEC
from trapiche.operators import regression as R

XY = f"{SPEC.net} double, {SPEC.output} double"


def noisy(n, seed=1, keys=False):
    rng = random.Random(seed)
    xs = [rng.uniform(10, 1000) for _ in range(n)]
    rows = [(x, 5 + 0.1 * x + rng.gauss(0, 3)) for x in xs]
    return [(f"m{i}", f"s{i % 7}", *r) for i, r in enumerate(rows)] if keys else rows


KEYED = "ingenio string, zafra string, " + XY


def test_exact_line(table):
    rows = [(float(x), 3 + 2.0 * x) for x in range(10)]
    model = R.fit(table(rows, XY))
    row = R.inference(model).first()
    assert (row["b0"], row["b1"], row["n"]) == (pytest.approx(3.0), pytest.approx(2.0), 10)
    assert row["SSE"] >= 0 and row["R2"] == pytest.approx(1.0)
    squares = R.residual_squares(table(rows, XY), model)
    second = R.inference(model, squares=squares).first()
    assert second["SSE"] == pytest.approx(0.0, abs=1e-20)


@pytest.mark.parametrize("rows", [[(5.0, 1.0), (5.0, 2.0), (5.0, 4.0)], [(1.0, 1.0), (2.0, 3.0)], [(1.0, 2.0)], []])
def test_degenerate_inputs_give_nulls(table, rows):
    row = R.inference(R.fit(table(rows, XY))).first()
    for name in ("SSE", "MSE", "se_b1", "t_crit", "p_b1", "F_stat", "R2_adj"):
        assert row[name] is None
    assert row["n"] == len(rows)


def test_agrees_with_pyspark_ml(table):
    df = table(noisy(400), XY)
    packed = VectorAssembler(inputCols=[SPEC.net], outputCol="features").transform(df)
    ml = LinearRegression(labelCol=SPEC.output, solver="normal", standardization=False).fit(packed)
    row = R.inference(R.fit(df)).first()
    assert row["b1"] == pytest.approx(ml.coefficients[0], rel=1e-10)
    assert row["b0"] == pytest.approx(ml.intercept, rel=1e-10)
    s = ml.summary
    assert [row["se_b1"], row["se_b0"]] == pytest.approx(list(s.coefficientStandardErrors), rel=1e-9)
    assert [row["t_b1"], row["t_b0"]] == pytest.approx(list(s.tValues), rel=1e-9)
    assert [row["p_b1"], row["p_b0"]] == pytest.approx(list(s.pValues), abs=1e-12)
    assert row["R2"] == pytest.approx(s.r2, rel=1e-10) and row["R2_adj"] == pytest.approx(s.r2adj, rel=1e-10)
    assert row["R2"] == pytest.approx(row["SSR"] / row["SST"])
    assert row["F_stat"] == pytest.approx(row["t_b1"] ** 2, rel=1e-9)
    assert row["p_f"] == pytest.approx(row["p_b1"], abs=1e-12)
    assert row["ci_b1"]["low"] < 0.1 < row["ci_b1"]["high"]


def test_published_seasons_against_closed_form(table):
    rows = [(r[2], r[4]) for r in SUMS]
    n, mx, my = len(rows), sum(r[0] for r in rows) / 11, sum(r[1] for r in rows) / 11
    slope = sum((x - mx) * (y - my) for x, y in rows) / sum((x - mx) ** 2 for x, _ in rows)
    row = R.fit(table(SUMS, SUMS_SCHEMA)).first()
    assert (row["n"], row["b1"]) == (n, pytest.approx(slope, rel=1e-12))
    assert row["b0"] == pytest.approx(my - slope * mx, rel=1e-10)


def test_moments_survive_a_far_offset_and_any_partitioning(table):
    rows = [(1e9 + x, y) for x, y in noisy(300)]
    near, far = R.fit(table(noisy(300), XY)).first(), R.fit(table(rows, XY).repartition(9)).first()
    assert far["b1"] == pytest.approx(near["b1"], rel=1e-6)
    assert far["sxx"] == pytest.approx(near["sxx"], rel=1e-6)


def test_residuals_of_the_fit(table):
    df = table(noisy(200), XY)
    scored = R.score(df, R.fit(df))
    total, along = scored.agg(F.sum("residual"), F.sum(F.col("residual") * F.col(SPEC.net))).first()
    assert abs(total) < 1e-8 and abs(along) < 1e-5


def test_split_is_stable_and_a_partition(table):
    df = table(noisy(2000, keys=True), KEYED)
    one = R.with_split(df, ["ingenio", "zafra"])
    two = R.with_split(df.repartition(11), ["ingenio", "zafra"])
    picked = {tuple(r) for r in one.where("is_test").select("ingenio", "zafra").collect()}
    assert picked == {tuple(r) for r in two.where("is_test").select("ingenio", "zafra").collect()}
    assert 330 < len(picked) < 470
    assert one.count() == 2000
    other = R.with_split(df, ["ingenio", "zafra"], seed=7)
    assert picked != {tuple(r) for r in other.where("is_test").select("ingenio", "zafra").collect()}


@pytest.mark.parametrize("n, expected", [(535, 107), (1, 1), (2, 1), (11, 3), (0, 0)])
def test_exact_split_sizes(table, n, expected):
    df = R.with_split(table(noisy(n, keys=True), KEYED), ["ingenio", "zafra"], exact=True)
    assert df.where("is_test").count() == expected
    assert df.where("NOT is_test").count() == n - expected


def brute_metrics(rows, test):
    train = [r for r, t in zip(rows, test) if not t]
    mx, my = (sum(r[i] for r in train) / len(train) for i in (0, 1))
    b1 = sum((x - mx) * (y - my) for x, y in train) / sum((x - mx) ** 2 for x, _ in train)
    b0 = my - b1 * mx

    def side(part):
        errors = [y - b0 - b1 * x for x, y in part]
        mean = sum(y for _, y in part) / len(part)
        sse = sum(e * e for e in errors)
        return (
            sum(map(abs, errors)) / len(part),
            math.sqrt(sse / len(part)),
            1 - sse / sum((y - mean) ** 2 for _, y in part),
        )

    return b0, b1, side(train), side([r for r, t in zip(rows, test) if t])


def test_metrics(table):
    df = R.with_split(table(noisy(535, keys=True), KEYED), ["ingenio", "zafra"], exact=True)
    collected = df.collect()
    b0, b1, train, test = brute_metrics([(r[2], r[3]) for r in collected], [r[4] for r in collected])
    model = R.fit(df, where=~F.col("is_test"))
    row = R.metrics(R.score(df, model), model).first()
    assert (row["intercepto_B0"], row["coeficiente_B1"]) == pytest.approx((b0, b1))
    assert (row["train_mae"], row["train_rmse"], row["train_r2"]) == pytest.approx(train)
    assert (row["test_mae"], row["test_rmse"], row["test_r2"]) == pytest.approx(test)
    assert (row["n_samples"], row["n_train"], row["n_test"]) == (535, 428, 107)


def test_r2_is_about_the_measured_rows_and_may_be_negative(table):
    df = table([(1.0, 1.0, False), (2.0, 2.0, False), (3.0, 3.0, False), (1.0, 9.0, True), (2.0, 8.9, True)], XY + ", is_test boolean")
    model = R.fit(df, where=~F.col("is_test"))
    assert R.metrics(R.score(df, model), model).first()["test_r2"] < 0


def test_fit_on_all_rows(table):
    df = table(noisy(100), XY)
    row, stats = R.fit_metrics(df).first(), R.inference(R.fit(df)).first()
    assert row["test_r2"] == pytest.approx(stats["R2"])
    assert row["test_rmse"] == pytest.approx(math.sqrt(stats["SSE"] / 100))


def test_groups_fit_as_if_alone(table):
    rows = [("a", *r) for r in noisy(50, 1)] + [("b", *r) for r in noisy(40, 2)] + [("c", 1.0, 2.0)]
    df = table(rows, "ingenio string, " + XY)
    models = R.fit(df, group_cols=["ingenio"])
    stats = {r["ingenio"]: r for r in R.inference(models).collect()}
    alone = R.inference(R.fit(df.where("ingenio = 'b'"))).first()
    assert stats["b"]["p_b0"] == pytest.approx(alone["p_b0"]) and stats["b"]["b1"] == pytest.approx(alone["b1"])
    assert stats["c"]["b1"] is None
    scored = R.score(df, models, group_cols=["ingenio"])
    assert scored.count() == 91
    assert scored.where("y_hat IS NULL").count() == 1
    squares = R.residual_squares(df, models, group_cols=["ingenio"])
    again = {r["ingenio"]: r for r in R.inference(models, squares=squares, group_cols=["ingenio"]).collect()}
    assert again["a"]["SSE"] == pytest.approx(stats["a"]["SSE"])


def exact_share(df, keys, **more):
    """(rows, tested rows) of an exact split, read twice."""
    split = R.with_split(df, keys, exact=True, **more)
    first = sorted(split.collect(), key=repr)
    assert first == sorted(split.collect(), key=repr)
    assert split.columns == [*df.columns, "is_test"]
    return len(first), sum(r["is_test"] for r in first), first


def test_exact_split_with_a_third_of_the_keys_equal(table):
    # Every key in turn is the hot one, so that the bound falls inside it for some.
    for hot in range(4):
        rows = [(f"m{hot}", "s", float(i), 0.0) for i in range(20)]
        rows += [(f"m{i}", "s", 100.0 + i, 0.0) for i in range(4, 43)]
        n, tested, _ = exact_share(table(rows, KEYED), ["ingenio", "zafra"])
        assert (n, tested) == (59, math.ceil(0.2 * 59))


def test_exact_split_of_one_key_is_by_lineage(table):
    df = table([("m", "s", float(i), 1.0) for i in range(50)], KEYED)
    n, tested, first = exact_share(df, ["ingenio", "zafra"], lineage=[SPEC.net])
    assert (n, tested) == (50, 10)
    again = R.with_split(df.repartition(7), ["ingenio", "zafra"], exact=True, lineage=[SPEC.net])
    assert sorted(again.collect(), key=repr) == first


def test_exact_split_of_rows_that_are_alike(table):
    rows = [("m", "s", 1.0, 1.0)] * 31 + [(None, "s", None, 2.0), ("m", None, 1.0, 1.0)]
    for lineage in (None, [], [SPEC.output]):
        n, tested, _ = exact_share(table(rows, KEYED), ["ingenio", "zafra"], lineage=lineage)
        assert (n, tested) == (33, 7)


def test_exact_split_of_nothing_and_of_everything(table):
    assert exact_share(table([], KEYED), ["ingenio"])[:2] == (0, 0)
    rows = [("m", "s", float(i % 2), 1.0) for i in range(9)]
    assert exact_share(table(rows, KEYED), ["ingenio"], test_fraction=1.0)[:2] == (9, 9)
    assert exact_share(table(rows, KEYED), ["ingenio"], test_fraction=0.0)[:2] == (9, 0)
