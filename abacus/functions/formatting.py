"""Presentation formats used by the served reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from abacus.functions._col import as_col


def month_label(c: Column | str) -> Column:
    """Month key -> ``'3/2024'``."""
    return F.date_format(as_col(c), "M/yyyy")


def last_updated_stamp() -> Column:
    """Run time in UTC as ``'2024-03-01 08:05 UTC'``, whatever the session zone."""
    utc = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd HH:mm 'UTC'")
