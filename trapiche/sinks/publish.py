"""Versions of a set of tables, switched by one pointer.

A run writes every table into a folder of its own; nothing that readers see is touched. What a
version holds, table by table and part by part, is a small manifest, and publishing is the
appearance of that one file. A run that ends anywhere before leaves the tables as they were.
Parts that a run did not rewrite stay where an earlier version wrote them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trapiche.sinks.writers import remove_folder

POINTERS, VERSIONS = "pointers", "versions"
# A table that is not cut into parts has one, of this name.
WHOLE = ""
_PART = "_part"


class AlreadyPublished(RuntimeError):
    """Another run published while this one was writing."""


@dataclass(frozen=True)
class Manifest:
    """Folders, below the root, of every part of every table of a version."""

    number: int
    tables: dict[str, dict[str, str]] = field(default_factory=dict)
    run: str = ""

    def parts(self, table: str) -> dict[str, str]:
        return dict(self.tables.get(table, {}))


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _read_text(spark: SparkSession, path: str) -> str:
    where, files = _files(spark, path)
    stream = files.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _pointers(spark: SparkSession, root: str) -> list[str]:
    where, files = _files(spark, f"{root}/{POINTERS}")
    if not files.exists(where):
        return []
    names = [s.getPath().getName() for s in files.listStatus(where)]
    return sorted(n for n in names if n.endswith(".json"))


def manifest(spark: SparkSession, root: str, number: int | None = None) -> Manifest | None:
    """The version published last, or the one of that number; None where there is none."""
    names = _pointers(spark, root)
    wanted = names[-1:] if number is None else [n for n in names if n == _pointer_name(number)]
    if not wanted:
        return None
    held = json.loads(_read_text(spark, f"{root}/{POINTERS}/{wanted[0]}"))
    return Manifest(held["number"], held["tables"], held["run"])


def _pointer_name(number: int) -> str:
    return f"{number:012d}.json"


class Version:
    """A version that is being written. `base` is the one that was published before it."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.base = manifest(spark, self.root)
        self.number = self.base.number + 1 if self.base else 1
        self.run = uuid.uuid4().hex
        self.below = f"{VERSIONS}/{self.number:012d}-{self.run}"

    @property
    def folder(self) -> str:
        return f"{self.root}/{self.below}"

    def write_whole(self, df: DataFrame, table: str) -> dict[str, str]:
        """Write a table that is replaced as a whole."""
        df.write.parquet(f"{self.folder}/{table}")
        return {WHOLE: f"{self.below}/{table}"}

    def write_parts(self, df: DataFrame, table: str, by: str) -> dict[str, str]:
        """Write the parts of a table that this version replaces, one folder per value of `by`.

        The column stays in the files, so that a part can be read by its folder alone. The
        rebalance hint splits a value that holds a large share of the rows.
        """
        marked = df.withColumn(_PART, F.col(by).cast("string")).hint("rebalance", _PART)
        marked.write.partitionBy(_PART).parquet(f"{self.folder}/{table}")
        where, files = _files(self.spark, f"{self.folder}/{table}")
        names = [s.getPath().getName() for s in files.listStatus(where) if s.isDirectory()]
        return {
            unquote(name.removeprefix(f"{_PART}=")): f"{self.below}/{table}/{name}"
            for name in sorted(names)
            if name.startswith(f"{_PART}=")
        }

    def publish(self, tables: Mapping[str, Mapping[str, str]]) -> Manifest:
        """Make this version the one that readers find.

        The pointer is written aside and renamed, so it is there whole or not at all. Two runs
        that started from one version want the same pointer: the second one fails.
        """
        made = Manifest(self.number, {n: dict(p) for n, p in tables.items()}, self.run)
        text = json.dumps({"number": made.number, "tables": made.tables, "run": made.run})
        aside, files = _files(self.spark, f"{self.root}/{POINTERS}/.{self.run}.tmp")
        final = _files(self.spark, f"{self.root}/{POINTERS}/{_pointer_name(self.number)}")[0]
        stream = files.create(aside, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if files.exists(final) or not files.rename(aside, final):
            files.delete(aside, False)
            raise AlreadyPublished(f"version {self.number} of {self.root} is there already")
        found = manifest(self.spark, self.root, self.number)
        if found is None or found.run != self.run:
            raise AlreadyPublished(f"version {self.number} of {self.root} is another run's")
        return made


def read_published(
    spark: SparkSession,
    root: str,
    table: str,
    schema: T.StructType,
    parts: Iterable[str] | None = None,
    number: int | None = None,
) -> DataFrame | None:
    """A published table, or some of its parts; None if it was never published.

    Only the folders of the wanted parts are listed. A column that a part lacks is null.
    """
    version = manifest(spark, root, number)
    if version is None or table not in version.tables:
        return None
    folders = version.parts(table)
    wanted = folders if parts is None else [p for p in parts if p in folders]
    paths = [f"{root.rstrip('/')}/{folders[p]}" for p in wanted]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def register_published(spark: SparkSession, name: str, root: str, table: str) -> str:
    """A catalog view of the parts of a published table, replaced by a single statement."""
    version = manifest(spark, root)
    folders = version.parts(table) if version else {}
    if not folders:
        raise ValueError(f"{root} has no published {table}")
    parts = [f"SELECT * FROM parquet.`{root.rstrip('/')}/{f}`" for f in folders.values()]
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {' UNION ALL '.join(parts)}")
    return name


def expire_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete folders that none of the last `keep` versions refers to, and older pointers.

    Folders of a run that is still writing have a higher number and stay.
    """
    names = _pointers(spark, root)
    kept, old = names[-keep:], names[:-keep]
    held = [manifest(spark, root, int(n.removesuffix(".json"))) for n in kept]
    used = {f for m in held for parts in m.tables.values() for f in parts.values()}
    used = {"/".join(f.split("/")[:2]) for f in used}
    last = held[-1].number if held else 0
    where, files = _files(spark, f"{root}/{VERSIONS}")
    there = [s.getPath().getName() for s in files.listStatus(where)] if files.exists(where) else []
    for name in old:
        files.delete(_files(spark, f"{root}/{POINTERS}/{name}")[0], False)
    gone = [
        name
        for name in sorted(there)
        if f"{VERSIONS}/{name}" not in used and int(name.split("-")[0]) <= last
    ]
    for name in gone:
        remove_folder(spark, f"{root}/{VERSIONS}/{name}")
    return gone
