"""Month spines: generated sequences of first-of-month dates.

Spines are generators (``explode(sequence(...))``), never joins: a category row
expands into its own months, and the bounds come from scalar aggregates computed
on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def month_sequence(start: Column, end: Column) -> Column:
    """First-of-month dates from ``start`` to ``end``; empty when ``start > end`` or a bound is NULL.

    Spark's ``sequence`` raises on a descending range, so it is guarded. Bounds
    must be first days of months (a start on the 31st would drift).
    """
    empty = F.array().cast("array<date>")
    return F.when(start <= end, F.sequence(start, end, F.expr("INTERVAL 1 MONTH"))).otherwise(empty)


def scalar_min(df: DataFrame, c: Column | str) -> Column:
    """``(select min(c) from df)`` as a column usable in any other DataFrame."""
    return df.select(F.min(c)).scalar()


def scalar_max(df: DataFrame, c: Column | str) -> Column:
    return df.select(F.max(c)).scalar()


def expand_months(df: DataFrame, start: Column, end: Column, month_col: str = "budget_month",
                  keep: Sequence[str] | None = None) -> DataFrame:
    """One output row per (input row, month in [start, end])."""
    cols = list(keep) if keep is not None else df.columns
    return df.select(F.explode(month_sequence(start, end)).alias(month_col), *cols)


def bounded_month_spine(bounds: DataFrame, start_col: str, end_col: str,
                        month_col: str = "budget_month") -> DataFrame:
    """A one-row bounds frame -> one row per month between its two columns.

    Its size is the number of months between the bounds, known before it is used.
    """
    return bounds.select(F.explode(month_sequence(F.col(start_col), F.col(end_col))).alias(month_col))
