"""A ledger of feed files: what was read, and what it held.

One row per file with its length, time, header, readability, seasons and, per column, how many
cells there are and how many parse as numbers. The next run compares a listing with it and opens
new and changed files only; column types are decided from its counts.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trapiche.functions.numbers import parse_number
from trapiche.sources.feeds import SOURCE_FILE, list_feeds

_COUNTS = T.MapType(T.StringType(), T.LongType())
LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("header", T.ArrayType(T.StringType())),
        T.StructField("readable", T.BooleanType()),
        T.StructField("rows", T.LongType()),
        T.StructField("present", _COUNTS),
        T.StructField("parsed", _COUNTS),
        T.StructField("seasons", T.ArrayType(T.StringType())),
    ]
)
_IDENTITY = ["path", "file", "length", "modified"]
NEW, CHANGED, GONE, SAME = "new", "changed", "gone", "same"


def list_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """`(path, file, length, modified)` of the feeds: Spark lists them, no content is read.

    `file` is the name that rows carry as their source.
    """
    if pattern.startswith("*"):
        # Refuses names that begin with an underscore, which Spark's readers pass over.
        list_feeds(spark, folder, f"_{pattern}")
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return found.select(
        "path",
        F.col("_metadata.file_path").alias("file"),
        "length",
        F.col("modificationTime").alias("modified"),
    )


def compare(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Every file of either side with its `status`: new, changed, gone or same."""
    old = ledger.select(*[F.col(c).alias(f"old_{c}") for c in _IDENTITY])
    both = listing.join(old, F.col("path") == F.col("old_path"), "full_outer")
    same = (F.col("length") == F.col("old_length")) & (F.col("modified") == F.col("old_modified"))
    status = (
        F.when(F.col("old_path").isNull(), NEW)
        .when(F.col("path").isNull(), GONE)
        .when(same, SAME)
        .otherwise(CHANGED)
    )
    return both.select(
        F.coalesce("path", "old_path").alias("path"),
        F.coalesce("file", "old_file").alias("file"),
        "length",
        "modified",
        status.alias("status"),
    )


def count_cells(feeds: DataFrame, columns: Sequence[str], season: str) -> DataFrame:
    """`(file, rows, present, parsed, seasons)` of parsed feeds, in one pass.

    Rows are counted by file and season first, which needs counts alone; the few rows of that
    are added up by file. Seasons are at most those that a file names.
    """
    there = [c for c in columns if c in feeds.columns]
    named = F.col(f"`{season}`") if season in feeds.columns else F.lit(None)
    counted = feeds.groupBy(
        F.col(SOURCE_FILE).alias("file"), named.cast("string").alias("season")
    ).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(F.col(f"`{c}`")).alias(f"present_{i}") for i, c in enumerate(there)],
        *[F.count(parse_number(F.col(f"`{c}`"))).alias(f"parsed_{i}") for i, c in enumerate(there)],
    )

    def totals(kind: str) -> F.Column:
        entries = [x for i, c in enumerate(there) for x in (F.lit(c), F.sum(f"{kind}_{i}"))]
        return F.create_map(*entries) if entries else F.create_map().cast(_COUNTS)

    return counted.groupBy("file").agg(
        F.sum("rows").alias("rows"),
        totals("present").alias("present"),
        totals("parsed").alias("parsed"),
        F.sort_array(F.collect_set("season")).alias("seasons"),
    )


def numeric_columns(ledger: DataFrame, columns: Iterable[str]) -> list[str]:
    """The columns that hold numbers, decided from the counts of the readable files.

    The rule is that of `conform.numeric_text_columns`, over the same rows, without the rows:
    more than half of all parse, or every cell that is there does. A column that a file lacks
    is missing in all its rows.
    """
    columns = list(columns)
    if not columns:
        return []
    read = ledger.where("readable")
    totals = read.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        *[
            F.coalesce(F.sum(F.coalesce(F.col(kind)[c], F.lit(0))), F.lit(0)).alias(f"{kind}_{i}")
            for kind in ("present", "parsed")
            for i, c in enumerate(columns)
        ],
    ).first()
    return [
        c
        for i, c in enumerate(columns)
        if totals[f"parsed_{i}"] > 0.5 * totals["rows"]
        or totals[f"parsed_{i}"] == totals[f"present_{i}"]
    ]
