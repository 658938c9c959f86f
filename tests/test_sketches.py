import pytest

from trapiche.operators import sketches as S

COLUMNS = ["mill", "load"]
SCHEMA = "season string, mill string, load long"


def rows():
    """Two seasons that share half of their loads."""
    first = [("a", f"m{i % 40}", i) for i in range(20_000)]
    second = [("b", f"m{i % 60}", i) for i in range(10_000, 30_000)]
    return first + second


@pytest.fixture(scope="module")
def stored(table):
    return S.distinct_sketches(table(rows(), SCHEMA), COLUMNS, ["season"]).cache()


def held(row, column, exact):
    return row[f"{column}_low"] <= exact <= row[f"{column}_high"]


def test_counts_of_each_group_are_within_the_stated_error(stored):
    told = {r["season"]: r for r in S.distinct_counts(stored, COLUMNS, ["season"]).collect()}
    assert {s: (r["n_rows"], r["mill"]) for s, r in told.items()} == {"a": (20_000, 40), "b": (20_000, 60)}
    assert held(told["a"], "load", 20_000) and held(told["b"], "load", 20_000)
    assert told["a"]["load_high"] - told["a"]["load_low"] < 0.11 * 20_000


def test_what_groups_share_is_counted_once(stored):
    row = S.distinct_counts(stored, COLUMNS).first()
    assert (row["n_rows"], row["mill"]) == (40_000, 60)
    assert held(row, "load", 30_000) and not held(row, "load", 40_000)


def test_merged_sketches_merge_again(stored):
    coarse = S.merge_sketches(stored, COLUMNS)
    assert S.distinct_counts(coarse, COLUMNS).first() == S.distinct_counts(stored, COLUMNS).first()


def test_a_selection_reads_sketches_only(stored, table):
    alone = S.distinct_sketches(
        table([r for r in rows() if r[0] == "b"], SCHEMA), COLUMNS, ["season"]
    )
    chosen = stored.where("season = 'b'")
    assert S.distinct_counts(chosen, COLUMNS).first() == S.distinct_counts(alone, COLUMNS).first()


def test_nulls_types_and_no_rows(table):
    few = table([("a", None, 1), ("a", None, 1), ("a", None, None), (None, "m", 2)], SCHEMA)
    told = S.distinct_sketches(few, COLUMNS, ["season"])
    shown = {r["season"]: (r["n_rows"], r["mill"], r["load"]) for r in S.distinct_counts(told, COLUMNS, ["season"]).collect()}
    assert shown == {"a": (3, 0, 1), None: (1, 1, 1)}
    as_text = S.distinct_sketches(few.selectExpr("season", "mill", "string(load) AS load"), COLUMNS, ["season"])
    both = S.distinct_counts(told.unionByName(as_text), COLUMNS).first()
    assert (both["n_rows"], both["mill"], both["load"]) == (8, 1, 2)
    nothing = S.distinct_counts(told.where("season = 'none'"), COLUMNS).first()
    assert set(nothing.asDict().values()) == {0}
