"""Date columns. Every month key is a ``DateType`` first-of-month, free of session zones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from abacus.functions._col import as_col


def _strict(text: Column, pattern: str) -> Column:
    """Text as a date; text that is no date raises, whatever the session's ANSI setting."""
    day = F.try_to_timestamp(text, F.lit(pattern)).cast("date")
    wrong = F.when(text.isNotNull(), F.raise_error(F.concat(F.lit("not a date: "), text)).cast("date"))
    return F.coalesce(day, wrong)  # parses each text once


def iso_date(c: Column | str) -> Column:
    """``'2024-01-05'`` (1- or 2-digit month/day accepted) -> date; bad text raises."""
    return _strict(as_col(c).cast("string"), "y-M-d")


def us_date(c: Column | str) -> Column:
    """Spreadsheet ``M/d/yyyy`` text -> date; ``''`` -> NULL; bad text raises."""
    return _strict(F.nullif(as_col(c).cast("string"), F.lit("")), "M/d/yyyy")


def month_start(c: Column | str) -> Column:
    """Any date or timestamp -> the first day of its month, as a date."""
    return F.trunc(F.to_date(as_col(c)), "MM")


def make_month(year: Column | str, month: Column | str) -> Column:
    return F.make_date(as_col(year), as_col(month), F.lit(1))


def year_of(c: Column | str) -> Column:
    return F.year(as_col(c))
