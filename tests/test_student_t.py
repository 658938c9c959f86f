"""Tails and critical values against published tables and the standard library."""

import math

import pytest
from pyspark.sql import functions as F

from trapiche.functions.student_t import f_tail, t_critical, t_two_sided_p

# Two-sided 95% and 99% points of Student's t.
POINTS = [
    (1, 12.706204736, 63.656741163),
    (2, 4.3026527297, 9.9248432009),
    (3, 3.1824463053, 5.8409093097),
    (5, 2.5705818356, 4.0321429836),
    (10, 2.2281388520, 3.1692726727),
    (30, 2.0422724563, 2.7499956536),
    (100, 1.9839715185, 2.6258905214),
]


def test_critical_values(table):
    df = table([(float(d), p95, p99) for d, p95, p99 in POINTS], "d double, p95 double, p99 double")
    rows = df.select(
        "p95", "p99", t_critical(0.05, "d").alias("c95"), t_critical(0.01, "d").alias("c99")
    ).collect()
    for row in rows:
        assert row["c95"] == pytest.approx(row["p95"], rel=1e-9)
        assert row["c99"] == pytest.approx(row["p99"], rel=1e-9)


def test_tail_inverts_the_critical_value(table):
    df = table([(d,) for d in (1.0, 4.0, 17.0, 9999.0, 10001.0, 1e6, 1e9)], "d double")
    for alpha in (0.9, 0.2, 0.05, 1e-4):
        df2 = df.withColumn("t", t_critical(alpha, "d"))
        for row in df2.select("d", t_two_sided_p("t", "d").alias("p")).collect():
            # Past MANY_DOF and t = 3 the last digits are lost.
            assert row["p"] == pytest.approx(alpha, rel=1e-9 if row["d"] < 1e7 else 1e-6)


def test_closed_forms(table):
    ts = [0.0, 0.01, 0.5, 1.0, 1.7, 1.7320508, 1.74, 3.0, 20.0, -2.0]
    df = table([(t,) for t in ts], "t double").withColumns({"one": F.lit(1.0), "two": F.lit(2.0), "huge": F.lit(1e9)})
    rows = df.select(
        "t", t_two_sided_p("t", "one").alias("a"), t_two_sided_p("t", "two").alias("b"), t_two_sided_p("t", "huge").alias("c")
    ).collect()
    for t, a, b, c in rows:
        t = abs(t)
        assert a == pytest.approx(1 - 2 * math.atan(t) / math.pi, abs=1e-12)
        assert b == pytest.approx(1 - t / math.sqrt(2 + t * t), abs=1e-12)
        assert c == pytest.approx(math.erfc(t / math.sqrt(2)), abs=1e-8)


def test_edges(table):
    df = table([(None, 5.0), (1.0, 0.0), (1.0, None), (float("inf"), 5.0)], "t double, d double")
    assert [r[0] for r in df.select(t_two_sided_p("t", "d")).collect()] == [None, None, None, 0.0]
    assert [r[0] for r in df.select(t_critical(0.05, "d")).collect()][1:3] == [None, None]
    assert table([(4.0, 8.0)], "f double, d double").select(f_tail("f", "d") - t_two_sided_p("2D", "d")).first()[0] == 0.0
    with pytest.raises(ValueError):
        t_critical(1.5, "d")
