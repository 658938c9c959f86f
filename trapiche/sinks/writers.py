"""Writers. All replace what was there before."""

from __future__ import annotations

import logging
import re
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trapiche.config import DEFAULT_SPEC, FeedSpec

log = logging.getLogger(__name__)

# The names of the catalog tables.
DETAIL_TABLE = "produccion_detallada"
SEASON_TABLE = "produccion_anual"


def work_folder(df_or_spark, shared: str | None = None) -> str:
    """A fresh folder below the folder that driver and executors share.

    That is `shared`, or the one the cluster names in `spark.checkpoint.dir`, or the one set by
    `setCheckpointDir`. Where there is none a local session gets a temporary folder; on a
    cluster it is an error, because every executor would write to a disk of its own.
    """
    spark = getattr(df_or_spark, "sparkSession", df_or_spark)
    shared = shared or spark.conf.get("spark.checkpoint.dir", None)
    shared = shared or spark.sparkContext.getCheckpointDir()
    if shared is None:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all of {master} shares")
        shared = tempfile.mkdtemp(prefix="trapiche-")
    return f"{shared.rstrip('/')}/trapiche-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote, in whatever store it is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def store(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write a DataFrame as Parquet and read it back.

    Cuts the lineage and lets every later pass read only the columns it needs; the copy
    outlives any executor.
    """
    path = path or work_folder(df)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str) -> str:
    """Cells with commas or quotes are quoted, and a quote inside is doubled."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def write_partitioned(df: DataFrame, path: str, by: str) -> DataFrame:
    """Write Parquet files partitioned by a text column and read them back.

    The rebalance hint gives even files: it splits a value that holds a large share of the rows
    and joins small ones.
    """
    df.hint("rebalance", by).write.mode("overwrite").partitionBy(by).parquet(path)
    # The reader puts a partition column last.
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def register_table(spark: SparkSession, name: str, path: str, partitioned: bool = False) -> str:
    """Make Parquet files that are there already a catalog table of that name."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=path, source="parquet")
    if partitioned:
        spark.catalog.recoverPartitions(name)
    return name


def write_record(df: DataFrame, path: str) -> str:
    """A one-row DataFrame (report, metrics, interpretation) as JSON."""
    df.write.mode("overwrite").json(path)
    return path


def write_model(model: DataFrame, path: str) -> str:
    model.write.mode("overwrite").parquet(path)
    return path


@dataclass(frozen=True)
class Loaded:
    """Where the tables went; `tables` is None when the catalog refused them or was not asked,
    `detail_csv` None when no such copy was asked for."""

    detail_csv: str | None
    season_csv: str
    tables: tuple[str, str] | None
    report: str


def write_tables(
    detail_path: str,
    seasons_path: str,
    report: DataFrame,
    folder: str,
    database: str | None = None,
    spec: FeedSpec = DEFAULT_SPEC,
    detail_csv: bool = False,
    catalog: bool = True,
) -> Loaded:
    """Write the season CSV and the profile report, and register the stored tables.

    The detail table is not written again: its partitioned files become the catalog table. A CSV
    copy of it is made on demand. Any failure of the catalog is logged and tolerated, a failing
    CSV write is not.
    """
    spark = report.sparkSession
    prefix = f"{database}." if database else ""
    detail = spark.read.parquet(detail_path).withColumn(spec.season, F.col(spec.season).cast("string"))
    seasons = spark.read.parquet(seasons_path)
    copied = write_csv(detail, f"{folder}/csv/detail") if detail_csv else None
    season_csv = write_csv(seasons, f"{folder}/csv/seasons")
    if not catalog:
        return Loaded(copied, season_csv, None, write_record(report, f"{folder}/report"))
    try:
        tables = (
            register_table(spark, f"{prefix}{DETAIL_TABLE}", detail_path, partitioned=True),
            register_table(spark, f"{prefix}{SEASON_TABLE}", seasons_path),
        )
    except Exception as error:
        log.warning("catalog tables not written: %s", error)
        tables = None
    return Loaded(copied, season_csv, tables, write_record(report, f"{folder}/report"))
