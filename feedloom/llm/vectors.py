"""Embedding vectors as whole numbers: a grid in Spark, matrices in Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Grid steps from zero up to which an entry counts; what lies beyond is handled like an infinite entry.
LARGEST = 2.0**31


def usable(vector: Column, scale: float) -> Column:
    """True for a vector without null, infinite or unrepresentable entries; false, never null, for all others."""
    fits = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double") * scale) < LARGEST, F.lit(False)) & ~F.isnan(c.cast("double")))
    return F.coalesce(vector.isNotNull() & fits, F.lit(False))


def on_grid(vector: Column, scale: float) -> Column:
    """floor(scale * c) of every entry, as array<bigint>."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("bigint"))


def dimensions(rows: DataFrame, name: str) -> int:
    """The largest number of entries of a vector; 0 for no rows."""
    return rows.agg(F.max(F.size(name)).alias("d")).first()["d"] or 0


def padded(vector: Column, size: int) -> Column:
    """The vector with zeros behind it up to ``size`` entries."""
    zeros = F.array_repeat(F.lit(0).cast("bigint"), F.lit(size) - F.size(vector))
    return F.when(F.size(vector) < size, F.concat(vector, zeros)).otherwise(vector)


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """A list column of vectors of ``size`` entries as a matrix of int64, a row per vector."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(column), size)
