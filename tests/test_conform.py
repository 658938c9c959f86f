import pytest
from pyspark.sql import functions as F

from trapiche.config import DEFAULT_SPEC as SPEC
from trapiche.functions.numbers import parse_number
from trapiche.functions.seasons import next_season, start_year
from trapiche.operators.conform import (
    cast_numbers,
    conform_types,
    drop_unmeasured,
    fill_missing,
    keep_season_range,
    numeric_text_columns,
)


@pytest.mark.parametrize(
    "text, value",
    [
        ("12.5", 12.5),
        (" 12.5 ", 12.5),
        ("1e3", 1000.0),
        ("-4", -4.0),
        ("1,234", None),
        ("", None),
        ("n/d", None),
        ("NaN", None),
        ("12d", None),
        ("1f", None),
        ("12D\t", None),
        (" -Inf ", float("-inf")),
        ("0x10", None),
        (None, None),
        ("inf", float("inf")),
    ],
)
def test_parse_number(table, text, value):
    assert table([(text,)], "t string").select(parse_number(F.col("t"))).first()[0] == value


def test_types_follow_the_data(table):
    half = [("1" if i < 50 else "x",) for i in range(100)]
    more = [("1" if i < 51 else "x",) for i in range(100)]
    sparse = [("1" if i < 3 else None,) for i in range(100)]
    empty = [(None,) for _ in range(100)]
    mixed_missing = [("1" if i < 40 else None if i < 90 else "x",) for i in range(100)]
    data = [a + b + c + d + e for a, b, c, d, e in zip(half, more, sparse, empty, mixed_missing)]
    df = table(data, "half string, more string, sparse string, empty string, mixed string")
    # Missing cells count as rows: 40 numbers among 100 rows with some text stay text.
    assert numeric_text_columns(df) == ["more", "sparse", "empty"]
    done = cast_numbers(df, ["more"])
    assert done.agg(F.sum("more")).first()[0] == 51.0
    assert dict(done.dtypes)["half"] == "string"


def test_forced_measures_and_fill(table):
    df = table(
        [("A", "2015-2016", "x", None, "1"), (None, "2015-2016", "y", None, "z")],
        f"ingenio string, zafra string, {SPEC.net} string, {SPEC.output} string, semana string",
    )
    done = conform_types(df, numeric=["semana"])
    assert [tuple(r) for r in done.orderBy("semana").collect()] == [
        ("", "2015-2016", 0.0, 0.0, 0.0),
        ("A", "2015-2016", 0.0, 0.0, 1.0),
    ]


def test_rows_without_measures_go_only_before_the_fill(table):
    df = table([(None, None), (1.0, None)], f"{SPEC.net} double, {SPEC.output} double")
    assert drop_unmeasured(df, [SPEC.net, SPEC.output]).count() == 1
    assert drop_unmeasured(fill_missing(df), [SPEC.net, SPEC.output]).count() == 2


def test_season_range(table):
    labels = ["2014-2015", "2015-2016", "2020/2021", "2025-2026", "2026-2027", "2015-16", None]
    df = table([(z,) for z in labels], "zafra string")
    kept = sorted(r[0] for r in keep_season_range(df).collect())
    assert kept == ["2015-2016", "2020/2021", "2025-2026"]
    other = table([(1,)], "x int")
    assert keep_season_range(other) is other


@pytest.mark.parametrize(
    "label, start, following",
    [
        ("2015-2016", 2015, "2016-2017"),
        ("2020/2021", None, None),
        ("x-2016", None, None),
        ("2015-", 2015, None),
        (" 2015 -2016", 2015, "2016-2017"),
        (None, None, None),
    ],
)
def test_season_labels(table, label, start, following):
    row = table([(label,)], "z string").select(start_year(F.col("z")), next_season(F.col("z"))).first()
    assert tuple(row) == (start, following)
