"""Readers of what the plans wrote: processed tables, JSON records and model tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trapiche.config import DEFAULT_SPEC, FeedSpec

# Field names of the stored records.
METRIC_DOUBLES = (
    "coeficiente_B1",
    "intercepto_B0",
    "train_mae",
    "test_mae",
    "train_rmse",
    "test_rmse",
    "train_r2",
    "test_r2",
)
METRIC_COUNTS = ("n_samples", "n_train", "n_test")
METRICS_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType()) for c in METRIC_DOUBLES]
    + [T.StructField(c, T.LongType()) for c in METRIC_COUNTS]
)
INTERPRETATION_SCHEMA = T.StructType(
    [
        T.StructField("ecuacion", T.StringType()),
        T.StructField("interpretacion_coeficiente", T.StringType()),
        T.StructField("r2_interpretacion", T.StringType()),
        T.StructField(
            "pronostico",
            T.StructType(
                [
                    T.StructField("siguiente_cana", T.DoubleType()),
                    T.StructField("siguiente_azucar", T.DoubleType()),
                    T.StructField("tendencia_cana", T.DoubleType()),
                ]
            ),
        ),
    ]
)


def _or_none(read) -> DataFrame | None:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str) -> DataFrame:
    """Columns of the schema by name, in its order; a column that the files lack is null."""
    if fmt != "csv":
        return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
    text = spark.read.option("header", True).option("escape", '"').csv(path)
    return text.select(
        *[
            (F.col(f"`{f.name}`") if f.name in text.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def read_detail(
    spark: SparkSession, path: str, spec: FeedSpec = DEFAULT_SPEC, fmt: str = "parquet"
) -> DataFrame | None:
    """The detail table; None when it was never written."""
    return _or_none(lambda: _read_table(spark, path, spec.detail_schema, fmt))


def read_seasons(
    spark: SparkSession, path: str, spec: FeedSpec = DEFAULT_SPEC, fmt: str = "parquet"
) -> DataFrame | None:
    """The season table; None when it was never written."""
    return _or_none(lambda: _read_table(spark, path, spec.season_schema, fmt))


def read_processed(
    spark: SparkSession,
    seasons_path: str,
    detail_path: str | None = None,
    spec: FeedSpec = DEFAULT_SPEC,
    fmt: str = "parquet",
) -> tuple[DataFrame, DataFrame | None]:
    """Season table, which must be there, and the detail table or None."""
    seasons = _read_table(spark, seasons_path, spec.season_schema, fmt)
    return seasons, read_detail(spark, detail_path, spec, fmt) if detail_path else None


def read_record(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """A JSON record such as metrics or interpretation; None when it was never written."""
    return _or_none(lambda: spark.read.schema(schema).option("multiLine", True).json(path))


def read_model(spark: SparkSession, path: str) -> DataFrame | None:
    """A model table; None when it was never written."""
    return _or_none(lambda: spark.read.parquet(path))
