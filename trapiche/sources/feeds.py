"""Scan of a folder of CSV feeds whose headers differ from file to file.

One scan is planned per distinct header, not per file, and every column is read
as text. Files are never handed to one reader across headers: Spark would align
them by position under the first header.
"""

from __future__ import annotations

import csv
import logging
import re
from collections import defaultdict
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trapiche.config import DEFAULT_SPEC, FeedSpec
from trapiche.functions.numbers import missing_to_null
from trapiche.sinks.writers import store, work_folder

log = logging.getLogger(__name__)

SOURCE_FILE = "_src_file"
SOURCE_BLOCK = "_src_block"
SOURCE_POSITION = "_src_pos"
SOURCE_SEASON = "_src_season"
UNREADABLE = "_src_unreadable"
REPLACED = "_src_replaced"

# Input order of a row: file, then block within the file, then row within the block.
LINEAGE = (SOURCE_FILE, SOURCE_BLOCK, SOURCE_POSITION)

HEADER_READERS = 16
LOGGED_FILES = 100
BYTE_ORDER_MARK = "\ufeff"
UNDECODED = "\ufffd"


def normalize_header(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Normalised column names; of columns that fall together the first is kept."""
    first_at = _first_positions(df.columns)
    numbered = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return numbered.select(*[F.col(f"c{i}").alias(name) for name, i in first_at.items()])


def merge_aliases(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """Old column names become canonical; where both exist, the old one fills the gaps."""
    columns = {name: F.col(f"`{name}`") for name in df.columns}
    return df.select(*[c.alias(n) for n, c in _merged(columns, aliases).items()])


def _first_positions(header: Sequence[str]) -> dict[str, int]:
    first_at: dict[str, int] = {}
    for i, name in enumerate(header):
        first_at.setdefault(normalize_header(name), i)
    return first_at


def _merged(columns: Mapping[str, Column], aliases: Mapping[str, str]) -> dict[str, Column]:
    merged = dict(columns)
    for old, new in aliases.items():
        if old not in merged or old == new:
            continue
        if new in merged:
            merged[new] = F.coalesce(merged[new], merged.pop(old))
        else:
            merged = {new if name == old else name: c for name, c in merged.items()}
    return merged


def _hadoop_path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def list_feeds(spark: SparkSession, folder: str, pattern: str = "*.csv") -> list[str]:
    """Paths of the feed files in name order. Only the listing is used: no job, no content.

    Spark's readers pass over names that begin with an underscore, so such a feed is an error
    rather than a file that is silently missing.
    """
    where, files = _hadoop_path(spark, f"{folder.rstrip('/')}/{pattern}")
    found = [s.getPath() for s in files.globStatus(where) or [] if s.isFile()]
    found = [p for p in found if not p.getName().startswith(".")]
    unread = sorted(p.toString() for p in found if p.getName().startswith("_"))
    if unread:
        raise ValueError(f"Spark does not read files whose names begin with '_': {', '.join(unread)}")
    return sorted(p.toString() for p in found)


def as_pattern(path: str) -> str:
    """The path of one file as a reader's pattern: characters that patterns use are escaped."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def _read_header(spark: SparkSession, path: str) -> tuple[str, ...] | None:
    """First non-blank line of a file, split as CSV; None for a file without one."""
    jvm = spark._jvm
    where, files = _hadoop_path(spark, path)
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(
        spark._jsc.hadoopConfiguration()
    )
    codec = codecs.getCodec(where)
    stream = files.open(where)
    try:
        plain = codec.createInputStream(stream) if codec else stream
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8"))
        line = lines.readLine()
        while line is not None and not line.lstrip(BYTE_ORDER_MARK).strip():
            line = lines.readLine()
    finally:
        stream.close()
    return tuple(next(csv.reader([line.lstrip(BYTE_ORDER_MARK)]))) if line is not None else None


def read_headers(spark: SparkSession, paths: Sequence[str]) -> dict[str, tuple[str, ...]]:
    """Header of every readable file, sixteen files at a time; no job, only the first lines."""
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        headers = list(pool.map(lambda path: _read_header(spark, path), paths))
    for path, header in zip(paths, headers):
        if header is None:
            log.warning("skipped %s: no header line", path)
    return {path: header for path, header in zip(paths, headers) if header is not None}


def _scan_group(
    spark: SparkSession, header: tuple[str, ...], paths: list[str], spec: FeedSpec, multi_line: bool
) -> DataFrame:
    """Files that share one header, with canonical names, missing cells as null, and lineage."""
    positional = [f"c{i}" for i in range(len(header))]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*positional, "overflow"]])
    scan = (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv([as_pattern(path) for path in paths])
    )
    cells = {n: missing_to_null(F.col(f"c{i}")) for n, i in _first_positions(header).items()}
    canonical = _merged(cells, spec.aliases)
    # The replacement character may stand for bytes that are not UTF-8, or for itself.
    replaced = F.concat_ws("", *positional).contains(UNDECODED)
    return scan.select(
        *[c.alias(n) for n, c in canonical.items()],
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.col("_metadata.file_block_start").alias(SOURCE_BLOCK),
        F.monotonically_increasing_id().alias(SOURCE_POSITION),
        F.regexp_replace(
            F.regexp_extract("_metadata.file_name", r"(\d{4}[_-]\d{4})", 1), "_", "-"
        ).alias(SOURCE_SEASON),
        # A row with more cells than the header makes the file unreadable.
        F.col("overflow").isNotNull().alias(UNREADABLE),
        replaced.alias(REPLACED),
    )


def read_feeds(
    spark: SparkSession,
    folder: str,
    spec: FeedSpec = DEFAULT_SPEC,
    pattern: str = "*.csv",
    multi_line: bool = False,
    headers: Mapping[str, tuple[str, ...]] | None = None,
) -> DataFrame:
    """All feeds of a folder as one DataFrame of text columns plus source lineage.

    `multi_line` allows line breaks inside quoted cells, at the price of one task per file.
    `headers` (path -> header) skips the header lookups when they are known from a catalog.
    """
    paths = list(headers) if headers is not None else list_feeds(spark, folder, pattern)
    if not paths:
        raise FileNotFoundError(f"no {pattern} files in {folder}")
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for path, header in (headers or read_headers(spark, paths)).items():
        groups[tuple(normalize_header(name) for name in header)].append(path)
    if not groups:
        raise FileNotFoundError(f"no readable {pattern} files in {folder}")
    scans = [_scan_group(spark, h, p, spec, multi_line) for h, p in groups.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def _not_utf8(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """Those of the files that hold bytes which are not UTF-8."""
    lines = spark.read.text([as_pattern(unquote(file)) for file in files])
    broken = lines.select("value", F.col("_metadata.file_path").alias(SOURCE_FILE))
    return broken.where(~F.is_valid_utf8("value")).select(SOURCE_FILE).distinct()


def unreadable_files(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Names of the files that have an unreadable row, stored below `folder`.

    One aggregate over three columns finds them; call it on a stored copy of the feeds. Only
    files that show a replacement character are looked at again, as bytes.
    """
    folder = folder or work_folder(df)
    marked = df.where(F.col(UNREADABLE) | F.col(REPLACED)).groupBy(SOURCE_FILE)
    files = store(marked.agg(F.max(UNREADABLE).alias(UNREADABLE)), f"{folder}/marked")
    bad = files.where(UNREADABLE).select(SOURCE_FILE)
    # At most the names that listing the folder brought to the driver already.
    unsure = [row[0] for row in files.where(~F.col(UNREADABLE)).select(SOURCE_FILE).collect()]
    if unsure:
        bad = store(bad.unionByName(_not_utf8(df.sparkSession, unsure)), f"{folder}/bad")
    return bad


def drop_unreadable_files(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Leave out every file that has an unreadable row, and log its name.

    Bad files leave by an anti-join, so their number does not matter to the plan. Their names
    are written below `folder`, by default a fresh work folder.
    """
    bad = unreadable_files(df, folder)
    names = [row[0] for row in bad.orderBy(SOURCE_FILE).limit(LOGGED_FILES + 1).collect()]
    for name in names[:LOGGED_FILES]:
        log.warning("skipped %s: rows longer than the header, or not UTF-8", name)
    if len(names) > LOGGED_FILES:
        log.warning("skipped more unreadable files than the %d named", LOGGED_FILES)
    return df.join(bad, SOURCE_FILE, "left_anti") if names else df
