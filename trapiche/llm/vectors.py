"""Vectors of whole numbers, exact in every step."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Sums of products below these are exact in 32-bit and 64-bit floats.
_EXACT_SINGLE, _EXACT_DOUBLE = 1 << 24, 1 << 53


def is_finite(vector: Column) -> Column:
    """False for a null vector and for one with a null or non-finite component."""
    infinite = F.lit(float("inf"))
    sound = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < infinite)
    )
    return F.coalesce(sound, F.lit(False))


def whole(vector: Column, factor: int) -> Column:
    """floor(factor * x) of every component, x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(factor)) * x.cast("double")))


def matrix(lists: pa.ListArray, width: int | None = None) -> np.ndarray:
    """A column of lists of whole numbers as rows of one array, short ones padded with zeros."""
    sizes = np.diff(lists.offsets.to_numpy())
    width = int(sizes.max(initial=0)) if width is None else width
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    rows = np.zeros((len(sizes), width), flat.dtype)
    rows[np.arange(width) < sizes[:, None]] = flat
    return rows


def lists_of(rows: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel(), kind))


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of the rows of two arrays of whole numbers, in the narrowest sound type."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < _EXACT_SINGLE:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if most < _EXACT_DOUBLE:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(object) @ b.astype(object).T
