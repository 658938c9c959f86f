"""Weekly runs that read new and corrected files only, and publish whole versions.

Four things are kept between runs, each a published table: the ledger of files, the latest row
of every producer and season of every single file, the detail and season tables, and the moments
of the detail. A corrected or removed file takes its own rows out of the second one; the seasons
that this touches, and those of the new rows, are rebuilt from it, the others stay in the
folders where an earlier version wrote them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trapiche.config import DEFAULT_SPEC, FeedSpec
from trapiche.functions.seasons import in_season_range
from trapiche.operators.conform import cast_numbers, conform_types, fill_missing
from trapiche.operators.derive import derive_yields
from trapiche.operators.moments import moments, moments_schema
from trapiche.operators.rollup import season_sums, with_growth, with_season_ratios
from trapiche.operators.snapshot import latest_rows
from trapiche.plans.etl import run_etl
from trapiche.plans.modelling import run_model
from trapiche.sinks.publish import (
    WHOLE,
    Manifest,
    Version,
    manifest,
    read_published,
    register_published,
)
from trapiche.sinks.writers import DETAIL_TABLE, SEASON_TABLE, remove_folder, store, work_folder
from trapiche.sources.feeds import (
    LINEAGE,
    REPLACED,
    SOURCE_FILE,
    UNREADABLE,
    read_feeds,
    read_headers,
    unreadable_files,
)
from trapiche.sources.ledger import (
    CHANGED,
    GONE,
    LEDGER_SCHEMA,
    NEW,
    SAME,
    compare,
    count_cells,
    list_files,
)

LEDGER, PER_FILE, DETAIL, SEASONS, MOMENTS = "ledger", "per_file", "detail", "seasons", "moments"


@dataclass(frozen=True)
class Update:
    """What a run did. `version` is None when nothing was published yet and no file is there."""

    version: Manifest | None
    read: list[str]
    gone: list[str]
    seasons: list[str]


def per_file_schema(spec: FeedSpec = DEFAULT_SPEC) -> T.StructType:
    doubles = (spec.period, *spec.summed, *spec.reported_yields)
    return T.StructType(
        [T.StructField(c, T.StringType()) for c in spec.keys]
        + [T.StructField(c, T.DoubleType()) for c in doubles]
        + [
            T.StructField(SOURCE_FILE, T.StringType()),
            T.StructField(LINEAGE[1], T.LongType()),
            T.StructField(LINEAGE[2], T.LongType()),
        ]
    )


def _in_range(spec: FeedSpec) -> Column:
    return in_season_range(F.col(spec.season), spec.first_season, spec.last_season)


def _all_columns(feeds: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns in order; one that no feed has is missing in every row."""
    return feeds.select(
        *[
            (F.col(c) if c in feeds.columns else F.lit(None).cast("string")).alias(c)
            for c in columns
        ]
    )


def _per_file(rows: DataFrame, spec: FeedSpec) -> DataFrame:
    """The latest row of every producer and season of every file.

    Keys and period tell which one it is; only the measures of that row are converted. The
    sort that finds it begins with the producer, as paths of files begin alike.
    """
    numeric = [c for c in spec.kept if c not in spec.keys]
    keyed = fill_missing(cast_numbers(rows.select(*spec.kept, *LINEAGE), [spec.period]))
    latest = latest_rows(keyed, (*spec.keys, SOURCE_FILE), spec, LINEAGE[1:])
    typed = conform_types(latest, spec, numeric)
    schema = per_file_schema(spec)
    return typed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _detail(per_file: DataFrame, spec: FeedSpec) -> DataFrame:
    latest = latest_rows(per_file, spec.keys, spec, LINEAGE).drop(spec.period, *LINEAGE)
    derived = derive_yields(latest, spec)
    return derived.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.detail_schema.fields]
    )


def _read_new(
    spark: SparkSession, todo: DataFrame, spec: FeedSpec, multi_line: bool, folder: str
) -> tuple[DataFrame, DataFrame]:
    """Rows per file of the new and changed files, and their rows of the ledger."""
    files = todo.select("path", "file", "length", "modified")
    # As many names as files to read, whose headers are looked up by name.
    headers = read_headers(spark, [row[0] for row in files.select("path").collect()])
    known = spark.createDataFrame(
        [(path, list(header)) for path, header in headers.items()],
        "header_path string, header array<string>",
    )
    ledger = files.join(known, F.col("path") == F.col("header_path"), "left").drop("header_path")
    if not headers:
        counts = {c: F.lit(None) for c in ("rows", "present", "parsed", "seasons")}
        empty = spark.createDataFrame([], per_file_schema(spec))
        return empty, _typed_ledger(ledger.withColumns(counts | {"readable": F.lit(False)}))
    feeds = read_feeds(spark, "", spec, multi_line=multi_line, headers=headers)
    columns = [*spec.kept, *LINEAGE]
    flags = feeds.withColumns({"_bad": F.col(UNREADABLE), "_odd": F.col(REPLACED)})
    rows = _all_columns(flags, [*columns, "_bad", "_odd"]).withColumnsRenamed(
        {"_bad": UNREADABLE, "_odd": REPLACED}
    )
    # Outside the season range only what decides on readability is kept.
    rows = store(
        rows.where(_in_range(spec) | F.col(UNREADABLE) | F.col(REPLACED)), f"{folder}/rows"
    )
    bad = unreadable_files(rows, folder)
    usable = rows.where(_in_range(spec)).join(bad, SOURCE_FILE, "left_anti")
    counts = count_cells(usable, spec.kept, spec.season).withColumnRenamed("file", "counted")
    unread = bad.select(F.col(SOURCE_FILE).alias("bad_file"))
    ledger = (
        ledger.join(counts, F.col("file") == F.col("counted"), "left")
        .join(unread, F.col("file") == F.col("bad_file"), "left")
        .withColumn("readable", F.col("header").isNotNull() & F.col("bad_file").isNull())
    )
    return _per_file(usable, spec), _typed_ledger(ledger)


def _typed_ledger(rows: DataFrame) -> DataFrame:
    filled = rows.withColumn("rows", F.coalesce(F.col("rows").cast("long"), F.lit(0)))
    return filled.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in LEDGER_SCHEMA.fields]
    )


def update_tables(
    spark: SparkSession,
    raw_folder: str,
    root: str,
    spec: FeedSpec = DEFAULT_SPEC,
    pattern: str = "*.csv",
    multi_line: bool = False,
    work: str | None = None,
    database: str | None = None,
) -> Update:
    """Bring the published tables below `root` up to date with a folder of feeds.

    Files are known by path, length and time. Only files that are new or differ are opened; of
    the published tables only seasons with rows of new, changed or removed files are read and
    written again. The result equals a whole run over the folder: the latest row of a producer
    and season is the latest of the latest rows of each file, ties going to the first file.
    Unlike `run_etl`, a measure that no feed has is 0 rather than absent, and feeds without a
    period count as period 0. With `database` the catalog views are replaced after publishing.
    Concurrent runs: the second to publish fails and changes nothing.
    """
    version, folder = Version(spark, root), work_folder(spark, work)
    try:
        ledger = read_published(spark, root, LEDGER, LEDGER_SCHEMA)
        if ledger is None:
            ledger = spark.createDataFrame([], LEDGER_SCHEMA)
        diff = store(compare(list_files(spark, raw_folder, pattern), ledger), f"{folder}/diff")
        names = {
            kind: [row[0] for row in diff.where(F.col("status").isin(*of)).select("path").collect()]
            for kind, of in {"read": [NEW, CHANGED], "gone": [GONE]}.items()
        }
        if not names["read"] and not names["gone"]:
            return Update(version.base, [], [], [])
        found, entries = _read_new(
            spark, diff.where(F.col("status").isin(NEW, CHANGED)), spec, multi_line, folder
        )
        found, entries = store(found, f"{folder}/found"), store(entries, f"{folder}/entries")
        stale = diff.where(F.col("status").isin(CHANGED, GONE)).select("file")
        left = ledger.join(diff.where(F.col("status") == SAME).select("path"), "path", "left_semi")
        # Seasons of the configured range, which is what the tables hold.
        touched = entries.select(F.explode("seasons").alias("season")).union(
            ledger.join(stale, "file", "left_semi").select(F.explode("seasons"))
        )
        seasons = sorted(row[0] for row in touched.distinct().collect())
        tables = _write(spark, version, spec, seasons, found, stale)
        merged = left.select(*LEDGER_SCHEMA.fieldNames()).union(entries)
        tables[LEDGER] = version.write_whole(merged, LEDGER)
        made = version.publish(tables)
    finally:
        remove_folder(spark, folder)
    if database is not None:
        prefix = f"{database}." if database else ""
        register_published(spark, f"{prefix}{DETAIL_TABLE}", root, DETAIL)
        register_published(spark, f"{prefix}{SEASON_TABLE}", root, SEASONS)
    return Update(made, sorted(names["read"]), sorted(names["gone"]), seasons)


def _write(
    spark: SparkSession,
    version: Version,
    spec: FeedSpec,
    seasons: list[str],
    found: DataFrame,
    stale: DataFrame,
) -> dict[str, dict[str, str]]:
    """Write the touched seasons; the folders of all parts of the new version."""
    root = version.root
    schemas = {PER_FILE: per_file_schema(spec), DETAIL: spec.detail_schema}
    schemas |= {MOMENTS: moments_schema(spec)}

    def replaced(table: str, written: Mapping[str, str]) -> dict[str, str]:
        kept = version.base.parts(table) if version.base else {}
        return {s: f for s, f in kept.items() if s not in seasons} | dict(written)

    def written(table: str, parts: Mapping[str, str]) -> DataFrame:
        paths = [f"{root}/{f}" for f in parts.values()]
        if not paths:
            return spark.createDataFrame([], schemas[table])
        return spark.read.schema(schemas[table]).parquet(*paths)

    old = read_published(spark, root, PER_FILE, schemas[PER_FILE], seasons)
    rows = found
    if old is not None:
        same_file = F.col(SOURCE_FILE) == F.col("file")
        rows = old.join(stale, same_file, "left_anti").unionByName(found)
    per_file = version.write_parts(rows, PER_FILE, spec.season)
    detail = version.write_parts(
        _detail(written(PER_FILE, per_file), spec), DETAIL, spec.season
    )
    fresh = written(DETAIL, detail)
    moment_rows = moments(fresh, spec.keys, spec=spec).select(*schemas[MOMENTS].fieldNames())
    moment_parts = version.write_parts(moment_rows, MOMENTS, spec.season)
    sums = season_sums(fresh, spec)
    stored = read_published(spark, root, SEASONS, spec.season_schema)
    if stored is not None:
        others = stored.where(~F.col(spec.season).isin(seasons)) if seasons else stored
        sums = others.select(*sums.columns).unionByName(sums)
    # One row per season, so the window over all of them is small.
    table = with_growth(with_season_ratios(sums, spec), spec).orderBy(spec.season)
    table = table.select(*spec.season_schema.fieldNames())
    return {
        PER_FILE: replaced(PER_FILE, per_file),
        DETAIL: replaced(DETAIL, detail),
        MOMENTS: replaced(MOMENTS, moment_parts),
        SEASONS: version.write_whole(table, SEASONS),
    }


def published(
    spark: SparkSession,
    root: str,
    table: str,
    spec: FeedSpec = DEFAULT_SPEC,
    seasons: Sequence[str] | None = None,
) -> DataFrame | None:
    """A table of `update_tables`; of the tables cut by season, only the given ones."""
    schemas: dict[str, Callable[[], T.StructType]] = {
        LEDGER: lambda: LEDGER_SCHEMA,
        PER_FILE: lambda: per_file_schema(spec),
        DETAIL: lambda: spec.detail_schema,
        SEASONS: lambda: spec.season_schema,
        MOMENTS: lambda: moments_schema(spec),
    }
    return read_published(spark, root, table, schemas[table](), seasons)


def publish_run(
    spark: SparkSession, raw_folder: str, root: str, spec: FeedSpec = DEFAULT_SPEC, **options
) -> Manifest:
    """A whole run with its model, every output of which appears at once.

    `run_etl` and `run_model` write into the folder of a new version, without the catalog;
    publishing is the last step. Options are those of `run_etl`.
    """
    version = Version(spark, root)
    etl = run_etl(spark, raw_folder, version.folder, spec, catalog=False, **options)
    run_model(etl.seasons, etl.detail, f"{version.folder}/model", spec=spec)
    outputs = {
        DETAIL: "detail",
        SEASONS: "seasons",
        "season_csv": "csv/seasons",
        "report": "report",
        "metrics": "model/metrics",
        "interpretation": "model/interpretation",
        "model": "model/model",
        "inference": "model/inference",
    }
    if etl.loaded.detail_csv:
        outputs["detail_csv"] = "csv/detail"
    return version.publish({n: {WHOLE: f"{version.below}/{p}"} for n, p in outputs.items()})


def output_path(spark: SparkSession, root: str, output: str) -> str | None:
    """Folder of an output of the version published last by `publish_run`."""
    version = manifest(spark, root)
    parts = version.parts(output) if version else {}
    return f"{root.rstrip('/')}/{parts[WHOLE]}" if WHOLE in parts else None
