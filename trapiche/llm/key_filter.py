"""A screen for 64-bit keys: binary fuse filters over a stored set, sent to every task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trapiche.llm.common import row_count
from trapiche.llm.fuse_filter import FuseFilter, build_filter

BUCKET_KEYS = 50_000
# Filters of so many keys, of nine bits each, go to every task. With more of them all pass.
SENT_KEYS = 10_000_000


class KeyFilter:
    """True for every key of the set, and for few others."""

    def __init__(self, parts: dict[int, FuseFilter] | None, buckets: int):
        self.parts, self.buckets = parts, buckets

    def holds(self, keys: np.ndarray) -> np.ndarray:
        keys = keys.astype(np.int64, copy=False)
        if self.parts is None:
            return np.ones(len(keys), bool)
        bucket = keys % self.buckets
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        held = np.zeros(len(keys), bool)
        for number, part in self.parts.items():
            at = order[edges[number] : edges[number + 1]]
            if len(at):
                held[at] = part.contains(keys[at].view(np.uint64))
        return held

    def test(self, key: Column) -> Column:
        """The same as a column; the key must not be null."""

        @F.pandas_udf("boolean")
        def held(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                yield pd.Series(self.holds(batch.to_numpy()))

        return held(key)


def _build(group: pa.Table) -> pa.Table:
    keys = group["key"].to_numpy()
    made = build_filter(keys.view(np.uint64))
    return pa.table(
        {
            "bucket": pa.array(keys[:1] % group["buckets"][0].as_py()).cast(pa.int32()),
            "seed": pa.array([made.seed], pa.int32()),
            "segment": pa.array([made.segment], pa.int32()),
            "cells": pa.array([made.cells.tobytes()], pa.binary()),
        }
    )


def key_filter(keys: DataFrame, sent: int = SENT_KEYS) -> KeyFilter:
    """Filters over the distinct, evenly hashed `keys(key long)`, built bucket by bucket.

    If there are more than `sent` keys the screen lets everything pass.
    """
    count = row_count(keys)
    if count > sent:
        return KeyFilter(None, 1)
    buckets = max(1, -(-count // BUCKET_KEYS))
    dealt = keys.select("key", F.lit(buckets).alias("buckets"))
    made = dealt.groupBy(F.pmod("key", F.lit(buckets))).applyInArrow(
        _build, "bucket int, seed int, segment int, cells binary"
    )
    parts = {
        row["bucket"]: FuseFilter(row["seed"], row["segment"], np.frombuffer(row["cells"], np.uint8))
        for row in made.collect()
    }
    return KeyFilter(parts, buckets)
