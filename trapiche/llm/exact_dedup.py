"""Exact duplicates by static filters over immutable snapshots.

A snapshot holds one row per distinct text: digest, smallest id, number of rows. Its digests
are dealt to buckets of bounded size, each with a binary fuse filter. A later batch is first
grouped by digest on its own; then the filter of a bucket screens the batch's digests. Only
positives are looked up in the exact buckets, and rows that share a digest are compared byte
by byte with the text of the row that stays. Digests are stored once; a filter over the rows of
texts found more than once keeps all other rows, and their texts, out of that shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trapiche.llm.common import fresh, named, row_count, single_spaced
from trapiche.llm.fuse_filter import FuseFilter, build_filter
from trapiche.llm.key_filter import SENT_KEYS, key_filter
from trapiche.sinks.writers import store

BUCKET_ROWS = 50_000


def digest_of(text: Column) -> Column:
    """SHA-256 of the text with single spaces; null counts as empty."""
    return F.unhex(F.sha2(single_spaced(text), 256))


def _bucket(digest: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(buckets)).cast("int")


def _keys(digests: pa.Array) -> np.ndarray:
    """The first eight bytes of each digest."""
    rows = np.frombuffer(b"".join(d[:8] for d in digests.to_pylist()), dtype="<u8")
    return rows.astype(np.uint64)


def _build(group: pa.Table) -> pa.Table:
    made = build_filter(_keys(group["digest"].combine_chunks()))
    return pa.table(
        {
            "bucket": pa.array([group["bucket"][0].as_py()], pa.int32()),
            "seed": pa.array([made.seed], pa.int32()),
            "segment": pa.array([made.segment], pa.int32()),
            "cells": pa.array([made.cells.tobytes()], pa.binary()),
        }
    )


def _screen(batch: pa.Table, filters: pa.Table) -> pa.Table:
    """Digests of one bucket that its filter lets through."""
    if len(batch) == 0 or len(filters) == 0:
        return batch.select(["digest"]).slice(0, 0)
    row = filters.to_pylist()[0]
    stored = FuseFilter(row["seed"], row["segment"], np.frombuffer(row["cells"], np.uint8))
    kept = stored.contains(_keys(batch["digest"].combine_chunks()))
    return batch.select(["digest"]).filter(pa.array(kept))


# Names that no input column has: digest, text, id and number of rows of what stays.
_REPS = [f"__rep_{c}" for c in ("digest", "body", "keep_id", "size")]
_FIRST = ["__first_digest", "__first_row"]


def _filters(digests: DataFrame, buckets: int) -> DataFrame:
    """One binary fuse filter per bucket of `digests(digest)`."""
    dealt = digests.select("digest", _bucket(F.col("digest"), buckets).alias("bucket"))
    return dealt.groupBy("bucket").applyInArrow(
        _build, "bucket int, seed int, segment int, cells binary"
    )


@dataclass(frozen=True)
class Snapshot:
    """An immutable set of texts: exact rows per digest, and one filter per bucket."""

    groups: DataFrame
    filters: DataFrame
    buckets: int


def group_by_digest(rows: DataFrame) -> DataFrame:
    """`rows(id, digest)` -> one row per digest: smallest id and number of rows."""
    return rows.groupBy("digest").agg(
        F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("size")
    )


def build_snapshot(rows: DataFrame, buckets: int) -> Snapshot:
    """Store the groups of `rows(id, digest)` and the filters of their buckets."""
    groups = store(group_by_digest(rows))
    return Snapshot(groups, store(_filters(groups, buckets)), buckets)


def screen(batch: DataFrame, snapshot: Snapshot) -> DataFrame:
    """Groups of a batch with the snapshot's group of the same digest, or nulls beside them.

    `batch` is the result of `group_by_digest`; a bucket holds distinct digests only, so its
    size does not depend on how often a text repeats.
    """
    dealt = batch.select("digest", _bucket(F.col("digest"), snapshot.buckets).alias("bucket"))
    positives = (
        dealt.groupBy("bucket")
        .cogroup(snapshot.filters.groupBy("bucket"))
        .applyInArrow(_screen, "digest binary")
    )
    known = snapshot.groups.selectExpr("digest", "keep_id AS known_id", "size AS known_size")
    return batch.join(positives.join(known, "digest"), "digest", "left")


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_rows: int = BUCKET_ROWS,
    sent_keys: int = SENT_KEYS,
) -> DataFrame:
    """Every row with `keep_id`, `group_size`, `kept` and `text_sha256` beside its own columns.

    Half of the ids, by hash, are the snapshot; the other half is the batch that it screens.
    Names that `docs` has already get an underscore. Nulls count as empty texts. The row with
    the smallest id of equal texts stays, rows without an id last; of rows that repeat with one
    id exactly one is kept. Rows whose digest agrees and whose bytes do not are not duplicates.
    An empty table gives an empty result. Hot texts: digests are counted before the shuffle and
    the rows of a hot text meet its one stored row in a join that adaptive execution splits.
    With more than `sent_keys` rows of repeated texts, all rows travel.
    """
    base = named(docs, id=id_col, text=text_col).withColumn("mark", F.xxhash64("id", "text"))
    digested = store(base.select("id", "mark", digest_of(F.col("text")).alias("digest")))
    buckets = max(1, -(-row_count(digested) // (2 * bucket_rows)))
    in_snapshot = F.pmod(F.xxhash64("id"), F.lit(2)) == 0
    rows = digested.select("id", "digest")
    snapshot = build_snapshot(rows.where(in_snapshot), buckets)
    batch = store(group_by_digest(rows.where(~in_snapshot)))
    screened = store(screen(batch, snapshot))
    met = screened.where("known_size IS NOT NULL")
    size = F.col("size") + F.coalesce("known_size", F.lit(0))
    repeated = store(
        screened.select("digest", F.least("keep_id", "known_id").alias("keep_id"), size.alias("size"))
        .union(snapshot.groups.join(met.select("digest"), "digest", "left_anti"))
        .where("size > 1")
    )
    # Rows of repeated texts, and one that stays of each: those whose texts are read again.
    shared = store(digested.join(repeated.select("digest", "keep_id"), "digest"))
    stays = F.col("id").eqNullSafe(F.col("keep_id"))
    keepers = store(
        shared.where(stays)
        .groupBy("digest")
        .agg(F.min("mark").alias("keep_mark"), F.count(F.lit(1)).alias("alike"))
    )
    read_again = key_filter(keepers.select(F.col("keep_mark").alias("key")).distinct(), sent_keys)
    texts = base.where(read_again.test(F.col("mark"))).select(
        "mark", digest_of(F.col("text")).alias("of"), single_spaced(F.col("text")).alias("body")
    )
    kept_text = (F.col("of") == F.col("digest")) & (F.col("mark") == F.col("keep_mark"))
    reps = store(
        texts.join(keepers, kept_text)
        .groupBy("digest")
        .agg(F.min("body").alias("rep_body"))
        .join(repeated, "digest")
        .withColumnRenamed("digest", "rep_digest")
    )
    travels = key_filter(shared.select(F.col("mark").alias("key")).distinct(), sent_keys)
    mark, digest, row = fresh(docs, "mark", "digest", "row")
    own, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    marked = docs.withColumn(mark, F.xxhash64(own, text))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    result = fresh(docs, "keep_id", "group_size", "kept", "text_sha256")

    def results(keep_id: Column, size: Column, kept: Column, digest: Column) -> list[Column]:
        facts = (keep_id, size.cast("long"), kept, F.lower(F.hex(digest)))
        return [*columns, *[fact.alias(name) for fact, name in zip(facts, result)]]

    alone = marked.where(~travels.test(F.col(mark)))
    alone = alone.select(results(own, F.lit(1), F.lit(True), digest_of(text)))
    moved = marked.where(travels.test(F.col(mark))).withColumn(digest, digest_of(text))
    # Ids are unique as a rule. Where rows repeat with one id and text, the first one stays.
    several = not keepers.where("alike > 1").isEmpty()
    if several:
        moved = store(moved.withColumn(row, F.monotonically_increasing_id()))
    reps = reps.select(*[F.col(c).alias(n) for c, n in zip(reps.columns, _REPS)])
    joined = moved.join(reps, F.col(digest) == F.col(_REPS[0]), "left")
    equal = single_spaced(text) == F.col(_REPS[1])
    keep_id = F.when(equal, F.col(_REPS[2])).otherwise(own)
    kept = keep_id.eqNullSafe(own)
    if several:
        first = (
            joined.where(equal & kept)
            .groupBy(F.col(digest).alias(_FIRST[0]))
            .agg(F.min(row).alias(_FIRST[1]))
        )
        joined = joined.join(first, F.col(digest) == F.col(_FIRST[0]), "left")
        kept = kept & F.coalesce(F.col(row) == F.col(_FIRST[1]), F.lit(True))
    size = F.when(equal, F.col(_REPS[3])).otherwise(F.lit(1))
    return alone.union(joined.select(results(keep_id, size, kept, F.col(digest))))
