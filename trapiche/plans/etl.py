"""From raw feeds to the detail and season tables."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trapiche.config import DEFAULT_SPEC, FeedSpec
from trapiche.functions.seasons import in_season_range
from trapiche.operators.conform import conform_types, keep_columns
from trapiche.operators.derive import derive_yields
from trapiche.operators.kpi import profile
from trapiche.operators.rollup import season_rollup
from trapiche.operators.snapshot import latest_snapshot
from trapiche.sinks.writers import (
    Loaded,
    remove_folder,
    store,
    work_folder,
    write_partitioned,
    write_tables,
)
from trapiche.sources.feeds import (
    LINEAGE,
    REPLACED,
    UNREADABLE,
    drop_unreadable_files,
    read_feeds,
)


@dataclass(frozen=True)
class EtlResult:
    detail: DataFrame
    seasons: DataFrame
    loaded: Loaded


def detail_from_feeds(
    feeds: DataFrame, spec: FeedSpec = DEFAULT_SPEC, numeric: Iterable[str] | None = None
) -> DataFrame:
    """Detail table from text feeds of `read_feeds` that are limited to the season range.

    Every column has the type that `spec.detail_schema` gives it, so what is stored can be read
    back: producer and season stay text whatever they look like, measures are numbers.
    `numeric` names text columns to convert before, for columns that the schema does not name.
    """
    kept = keep_columns(feeds, [*spec.kept, *LINEAGE])
    if numeric is None:
        numeric = [c for c in keep_columns(feeds, spec.kept).columns if c not in spec.keys]
    typed = conform_types(kept, spec, numeric)
    detail = derive_yields(latest_snapshot(typed, spec, LINEAGE), spec)
    types = {f.name: f.dataType for f in spec.detail_schema.fields}
    return detail.select(
        *[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in detail.columns]
    )


def run_etl(
    spark: SparkSession,
    raw_folder: str,
    out_folder: str,
    spec: FeedSpec = DEFAULT_SPEC,
    pattern: str = "*.csv",
    numeric: Iterable[str] | None = None,
    database: str | None = None,
    multi_line: bool = False,
    work: str | None = None,
    detail_csv: bool = False,
    catalog: bool = True,
) -> EtlResult:
    """Read feeds, conform, keep the latest snapshot, derive, roll up and write everything.

    The feeds are parsed once, into Parquet in a folder below `work` (by default the one of
    `work_folder`): the check for unreadable files then reads three columns instead of the CSV
    again. That copy is removed at the end. The detail table is written once, partitioned by
    season, and its files are the catalog table, unless `catalog` is off; the roll-up and the
    report read it. Tables are replaced in place: `plans.incremental` publishes whole versions.
    """
    feeds = read_feeds(spark, raw_folder, spec, pattern, multi_line)
    kept = keep_columns(feeds, [*spec.kept, *LINEAGE, UNREADABLE, REPLACED])
    if spec.season in feeds.columns:
        # Rows that make their file unreadable are carried along until the file is dropped.
        in_range = in_season_range(F.col(spec.season), spec.first_season, spec.last_season)
        kept = kept.where(in_range | F.col(UNREADABLE) | F.col(REPLACED))
    folder = work_folder(spark, work)
    try:
        usable = drop_unreadable_files(store(kept, f"{folder}/feeds"), folder)
        if spec.season in feeds.columns:
            usable = usable.where(
                in_season_range(F.col(spec.season), spec.first_season, spec.last_season)
            )
        detail_path, seasons_path = f"{out_folder}/detail", f"{out_folder}/seasons"
        detail = detail_from_feeds(usable, spec, numeric)
        if spec.season in detail.columns:
            detail = write_partitioned(detail, detail_path, spec.season)
        else:
            detail = store(detail, detail_path)
        seasons = store(season_rollup(detail, spec), seasons_path)
        report = profile(detail, spec)
        loaded = write_tables(
            detail_path, seasons_path, report, out_folder, database, spec, detail_csv, catalog
        )
    finally:
        remove_folder(spark, folder)
    return EtlResult(detail, seasons, loaded)
