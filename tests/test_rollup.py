import math

import pytest

from golden import COLUMNS, SEASONS, SUMS, SUMS_SCHEMA
from trapiche.config import DEFAULT_SPEC as SPEC
from trapiche.operators.derive import derive_yields, scale_columns, with_start_year
from trapiche.operators.rollup import season_rollup, season_sums, with_growth

DETAIL = "ingenio string, zafra string, " + ", ".join(f"{m} double" for m in SPEC.summed)


def detail_row(mill, season, gross, net, area, output):
    return (mill, season, gross, net, area, output, 1.0, 2.0, 3.0, 4.0)


def test_published_season_table(table):
    got = season_rollup(table(SUMS, SUMS_SCHEMA))
    assert got.columns == COLUMNS
    assert [tuple(r) for r in got.collect()] == SEASONS


def test_rollup_adds_up_and_ignores_partitioning(table):
    rows = [detail_row(f"m{i}", f"20{15 + i % 3}-20{16 + i % 3}", i + 1.0, i + 0.5, 2.0, i * 0.25) for i in range(60)]
    df = table(rows, DETAIL)
    first = season_rollup(df).collect()
    again = season_rollup(df.repartition(7)).collect()
    assert first == again
    assert sum(r[SPEC.output] for r in first) == sum(r[5] for r in rows)


def test_guards_against_zero(table):
    df = table(
        [
            detail_row("a", "2015-2016", 10.0, 8.0, 2.0, 1.0),
            detail_row("b", "2015-2016", 0.0, 8.0, 0.0, 1.0),
            detail_row("c", "2016-2017", 10.0, 0.0, 2.0, 1.0),
        ],
        DETAIL,
    )
    rows = {r["ingenio"]: r for r in derive_yields(df).collect()}
    assert (rows["a"][SPEC.industrial_yield], rows["a"][SPEC.extraction]) == (12.5, 80.0)
    assert (rows["b"][SPEC.industrial_yield], rows["b"][SPEC.extraction]) == (0.0, 0.0)
    assert (rows["c"][SPEC.industrial_yield], rows["c"][SPEC.extraction]) == (0.0, 0.0)
    assert rows["c"][SPEC.start_year] == 2016
    last = season_rollup(df).collect()[-1]
    assert (last[SPEC.season_yield], last[SPEC.season_field_yield]) == (0.0, 0.0)


def growth(df, **options):
    return [r[SPEC.growth] for r in with_growth(df, **options).orderBy("zafra").collect()]


def test_growth_from_zero(table):
    df = table(
        [("a", 0.0), ("b", 0.0), ("c", 5.0), ("d", 10.0), ("e", 0.0)],
        f"zafra string, {SPEC.output} double",
    )
    assert growth(df) == [0.0, 0.0, math.inf, 100.0, -100.0]
    assert growth(df, zero_base="null") == [0.0, None, None, 100.0, -100.0]
    assert growth(df, first=None) == [None, 0.0, math.inf, 100.0, -100.0]
    with pytest.raises(ValueError):
        growth(df, zero_base="other")


def test_growth_per_group(table):
    rows = [detail_row(m, s, 1.0, 1.0, 1.0, v) for m, s, v in [("a", "1", 10.0), ("a", "2", 20.0), ("b", "1", 4.0), ("b", "2", 1.0)]]
    got = season_rollup(table(rows, DETAIL), group_cols=["ingenio"])
    got = got.orderBy("ingenio", "zafra").collect()
    assert [(r["ingenio"], r["zafra"], r[SPEC.growth]) for r in got] == [
        ("a", "1", 0.0), ("a", "2", 100.0), ("b", "1", 0.0), ("b", "2", -75.0),
    ]


def test_three_sum_variant_and_helpers(table):
    df = table(SUMS, SUMS_SCHEMA)
    three = season_sums(df, measures=[SPEC.net, SPEC.area, SPEC.output])
    assert three.columns == ["zafra", SPEC.net, SPEC.area, SPEC.output]
    dated = with_start_year(three)
    assert {r["anio_inicio"] for r in dated.collect()} == set(range(2015, 2026))
    assert with_start_year(dated) is dated
    assert scale_columns(df, {SPEC.net: 1e6}).first()[SPEC.net] == SUMS[0][2] / 1e6
