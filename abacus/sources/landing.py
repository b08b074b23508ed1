"""The landing area: one Parquet dataset per entity, read by logical name."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def landing_path(root: str, name: str) -> str:
    return os.path.join(root, name)


def scan(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Landing dataset by logical name (``'accounts'``, ``'category-groups'``, ...)."""
    return spark.read.parquet(landing_path(root, name))


def scan_project(df: DataFrame, columns: Sequence[str], renames: Mapping[str, str] | None = None) -> DataFrame:
    """Explicit column list (pruned down to the Parquet reader), optionally renamed."""
    renames = renames or {}
    return df.select(*[F.col(c).alias(renames.get(c, c)) for c in columns])
