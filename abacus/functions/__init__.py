"""Column helpers (``Column -> Column``). All are built-in Spark expressions: no UDFs."""

from abacus.functions.amounts import MILLI, amount_from_text, milli, round_milli, to_units, whole
from abacus.functions.dates import iso_date, make_month, month_start, us_date, year_of
from abacus.functions.labels import clean_label, group_mapping, split_part, strip_emoji, subgroup
from abacus.functions.formatting import last_updated_stamp, month_label

__all__ = [
    "MILLI", "amount_from_text", "milli", "round_milli", "to_units", "whole",
    "iso_date", "make_month", "month_start", "us_date", "year_of",
    "clean_label", "group_mapping", "split_part", "strip_emoji", "subgroup",
    "last_updated_stamp", "month_label",
]
