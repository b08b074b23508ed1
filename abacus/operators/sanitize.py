"""Serving cleanup of non-finite numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def nonfinite_to_null(df: DataFrame) -> DataFrame:
    """NaN, +inf and -inf -> NULL in every float/double column; other columns untouched."""
    fixes = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, (DoubleType, FloatType)):
            c = F.col(field.name)
            bad = F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
            fixes[field.name] = F.when(bad, F.lit(None)).otherwise(c)
    return df.withColumns(fixes) if fixes else df
