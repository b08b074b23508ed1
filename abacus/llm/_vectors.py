"""Vectors as integers: the columns of embedding tables and their numpy form."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Larger integers would let sums of products leave 64 bits.
LIMIT = 1 << 27


def integers(df: DataFrame, vector_col: str, scale: int, out: str, condition: Column | None = None) -> DataFrame:
    """Rows whose vector is not null and has only finite components, with ``out`` the array of
    floor(scale * component) in double precision; a component beyond 2^27 raises."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.col(vector_col).isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    kept = df.where(F.coalesce(finite if condition is None else finite & condition, F.lit(False)))
    whole = F.transform(x, lambda c: F.floor(F.when(F.abs(c * scale) <= LIMIT, c * scale).otherwise(
        F.raise_error(F.lit("a vector's component is beyond the range of integer scores")).cast("double"))).cast("int"))
    return kept.withColumn(out, whole)


def lengths(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.diff(column.offsets.to_numpy())


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """The rows of an array column, all of length ``dim``, as int64."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)
