"""Filters bounded by a scalar computed from another table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bounded_by_max(df: DataFrame, c: Column | str, other: DataFrame, other_col: str) -> DataFrame:
    """``df WHERE c <= (SELECT max(other_col) FROM other)``; an empty ``other`` keeps nothing."""
    col = F.col(c) if isinstance(c, str) else c
    return df.where(col <= other.select(F.max(other_col)).scalar())
