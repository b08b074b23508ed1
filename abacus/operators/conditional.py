"""Conditional columns and conditional sums (``sum(if(pred, x, 0))``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def when_else_zero(pred: Column, value: Column) -> Column:
    """``value`` where ``pred`` holds, else 0 (a NULL predicate also gives 0)."""
    return F.when(pred, value).otherwise(F.lit(0))


def conditional_columns(df: DataFrame, specs: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    """Add one ``when_else_zero`` column per ``(name, predicate, value)``."""
    return df.withColumns({name: when_else_zero(pred, value) for name, pred, value in specs})


def conditional_sums(df: DataFrame, keys: Sequence[Column | str],
                     specs: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    """Group by ``keys`` and sum each ``when_else_zero(predicate, value)``.

    One hash aggregate with a map-side partial step, so hot keys shrink before the
    shuffle.
    """
    aggs = [F.sum(when_else_zero(pred, value)).alias(name) for name, pred, value in specs]
    return df.groupBy(*keys).agg(*aggs)


def sum_measures(df: DataFrame, keys: Sequence[Column | str], measures: Sequence[str]) -> DataFrame:
    """Plain ``sum`` of every measure, keeping its name."""
    return df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])
