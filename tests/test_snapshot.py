import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trapiche.operators.snapshot import latest_snapshot

SCHEMA = "ingenio string, zafra string, semana string, v double, pos int"


def brute(rows):
    """First row with the highest week per key, weeks that are not numbers counting as 0."""
    best = {}
    for mill, season, week, value, pos in sorted(rows, key=lambda r: r[4]):
        try:
            number = float(week)
        except (TypeError, ValueError):
            number = 0.0
        if (mill, season) not in best or number > best[mill, season][0]:
            best[mill, season] = (number, value)
    return {(m, s, v) for (m, s), (_, v) in best.items()}


def result(df):
    return {tuple(r) for r in latest_snapshot(df, input_order=["pos"]).collect()}


def test_last_week_first_on_ties_and_blank_mill(table):
    rows = [
        ("A", "s", "1", 1.0, 0),
        ("A", "s", "10", 2.0, 1),
        ("A", "s", "9", 3.0, 2),
        ("A", "s", "10", 4.0, 3),
        ("", "s", "x", 5.0, 4),
        ("", "s", "0", 6.0, 5),
        ("", "t", None, 7.0, 6),
    ]
    df = table(rows, SCHEMA)
    assert result(df) == brute(rows) == {("A", "s", 2.0), ("", "s", 5.0), ("", "t", 7.0)}
    assert latest_snapshot(df, input_order=["pos"]).columns == ["ingenio", "zafra", "v"]


def test_without_period_the_table_passes(table):
    df = table([("A", "s", 1.0)], "ingenio string, zafra string, v double")
    assert latest_snapshot(df).collect() == df.collect()


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["A", "B", ""]),
            st.sampled_from(["s", "t"]),
            st.sampled_from(["1", "2", "3", "x", None]),
            st.floats(0, 100, allow_nan=False),
        ),
        min_size=1,
        max_size=30,
    ),
    st.randoms(use_true_random=False),
)
def test_any_row_order_and_partitioning(table, data, shuffler: random.Random):
    rows = [(*r, i) for i, r in enumerate(data)]
    expected = brute(rows)
    mixed = rows[:]
    shuffler.shuffle(mixed)
    assert result(table(mixed, SCHEMA).repartition(3)) == expected


def test_hot_key_and_running_sums(spark):
    """A key with a third of all rows; the snapshot of running sums is the plain sum."""
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("m"), F.col("id") % 500)).alias("ingenio"),
        F.lit("s").alias("zafra"),
        F.col("id").alias("semana"),
        F.col("id").cast("double").alias("v"),
    )
    snap = latest_snapshot(df)
    expected = df.groupBy("ingenio").agg(F.max("v").alias("v"))
    assert snap.select("ingenio", "v").exceptAll(expected).count() == 0
    assert snap.count() == expected.count()
    assert latest_snapshot(snap.withColumn("semana", F.lit(1))).exceptAll(snap).count() == 0
