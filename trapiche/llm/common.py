"""Helpers that several operators share."""

from __future__ import annotations

import functools
import shutil
import tempfile
from collections.abc import Callable, Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import trapiche

# What the contracts call white space.
SPACE_BYTES = r"[\x20\x09-\x0D]"


# Rows of an Arrow batch at most: rows are whole documents, and a batch is held several times on
# its way through a Python worker.
BATCH_ROWS = 1_000
_BATCH_ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"

_shipped: set[str] = set()


def ship_library(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, in case it is not installed there.

    Functions that run inside tasks are imported from it.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(trapiche.__file__).parent
    where = tempfile.mkdtemp(prefix="trapiche-")
    context.addPyFile(
        shutil.make_archive(f"{where}/trapiche", "zip", package.parent, package.name)
    )
    _shipped.add(context.applicationId)


def on_executors(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A query or stage, called with the session first, whose tasks find this package.

    The session's Arrow batches are made small enough for whole documents.
    """

    @functools.wraps(query)
    def run(spark: SparkSession, *args) -> DataFrame:
        ship_library(spark)
        if not 0 < int(spark.conf.get(_BATCH_ROWS_KEY, "0")) <= BATCH_ROWS:
            spark.conf.set(_BATCH_ROWS_KEY, str(BATCH_ROWS))
        return query(spark, *args)

    return run


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names close to `names` that the DataFrame does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"{name}_"
        taken.add(name.lower())
        found.append(name)
    return found


def named(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names; other columns cannot clash."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def single_spaced(text: Column) -> Column:
    """Every run of white space as one space; a null text as the empty text."""
    runs = rf"[\x09-\x0D]{SPACE_BYTES}*|\x20{SPACE_BYTES}+"
    return F.regexp_replace(F.coalesce(text, F.lit("")), runs, " ")


def copy_number(df: DataFrame, id_col: str, keys: Iterable[str]) -> Column:
    """1 for the first of the rows that share `keys`, 2 for the next one, and so on.

    Ids are unique as a rule, and then this is a constant: one aggregate over the id column
    tells. Only where an id repeats are rows numbered by a window.
    """
    counts = df.groupBy(F.col(f"`{id_col}`")).count()
    if counts.where("count > 1").isEmpty():
        return F.lit(1)
    keys = list(keys)
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))


def row_count(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1))).first()[0]
