"""A weekly cumulative feed derived from `lineitem`.

Producer is the supplier, a season runs from October to September, and every report
holds the running totals of its season, as real feeds do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trapiche.config import DEFAULT_SPEC as SPEC

# What each measure adds up, line by line, and how many of that make one. Whole numbers add up to
# the same sum in any order, and one division at the end rounds once.
LINE_VALUES = {
    SPEC.gross: ("quantity * (100 + tax)", 10_000),
    SPEC.net: ("quantity", 100),
    SPEC.area: ("1L", 1),
    SPEC.output: ("price", 100),
    SPEC.grades[0]: ("IF(l_returnflag = 'A', price, 0L)", 100),
    SPEC.grades[1]: ("IF(l_returnflag = 'N', price, 0L)", 100),
    SPEC.grades[2]: ("IF(l_returnflag = 'R', price, 0L)", 100),
    SPEC.grades[3]: ("IF(l_linestatus = 'O', price, 0L)", 100),
}


def weekly_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cumulative row per producer, season and week with deliveries."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(
        "*",
        "date(l_shipdate) AS day",
        "year(l_shipdate) - IF(month(l_shipdate) < 10, 1, 0) AS start",
        "cast(round(l_quantity * 100) AS bigint) AS quantity",
        "cast(round(l_tax * 100) AS bigint) AS tax",
        "cast(round(l_extendedprice * 100) AS bigint) AS price",
    )
    # Integer keys until the data is small: labels are made from weekly sums, not from lines.
    weekly = (
        lines.selectExpr("*", "datediff(day, make_date(start, 10, 1)) div 7 + 1 AS week")
        .groupBy("l_suppkey", "start", "week")
        .agg(*[F.expr(f"sum({value}) AS {m}") for m, (value, _) in LINE_VALUES.items()])
        .selectExpr(
            f"string(l_suppkey) AS {SPEC.producer}",
            f"concat(start, '-', start + 1) AS {SPEC.season}",
            f"int(week) AS {SPEC.period}",
            *SPEC.summed,
        )
    )
    to_date = (
        Window.partitionBy(SPEC.producer, SPEC.season)
        .orderBy(SPEC.period)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = [
        (F.sum(m).over(to_date).cast("double") / float(LINE_VALUES[m][1])).alias(m)
        for m in SPEC.summed
    ]
    return weekly.select(SPEC.producer, SPEC.season, SPEC.period, *running)


def text_panel(panel: DataFrame) -> DataFrame:
    """The panel as a raw feed would spell it: every cell is text, a missing measure `null`."""
    return panel.selectExpr(
        SPEC.producer,
        SPEC.season,
        f"string({SPEC.period}) AS {SPEC.period}",
        *[f"coalesce(string(cast({m} AS decimal(24,4))), 'null') AS {m}" for m in SPEC.summed],
    )
