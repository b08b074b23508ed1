"""Money columns.

Inside the warehouse every amount is an exact integer number of thousandths of a
unit (``bigint`` "milli"), which is how the budget source delivers amounts. Sums
and additions stay primitive 64-bit integer arithmetic inside whole-stage codegen
(exact, independent of shuffle order, overflow-checked under ANSI), and rounding is
exact half-away-from-zero integer arithmetic. Decimal arithmetic above 18 digits
would fall back to ``BigDecimal`` objects, several times slower. Amounts become
DOUBLE units only at the serving edge (``to_units``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from abacus.functions._col import as_col

MILLI = "bigint"
# Text amounts are read as decimals with three places (more places round half up).
TEXT_AMOUNT = "decimal(18,3)"
# Amounts so plain and small that their digits are a 64-bit number of thousandths.
PLAIN_AMOUNT = r"\A-?[0-9]{1,11}(?:\.[0-9]{1,3})?\z"


def whole(c: Column | str) -> Column:
    """A DOUBLE rounded to a whole number, half away from zero: ``round(c)`` as ``bigint``.

    The same numbers, as a double less its whole part is exact, without a ``BigDecimal`` for each.
    """
    x = as_col(c)
    cut = x.cast(MILLI)
    rest = x - cut
    return cut + F.when(rest >= 0.5, 1).when(rest <= -0.5, -1).otherwise(0)


def milli(c: Column | str) -> Column:
    """A source amount in thousandths, as the warehouse's money type."""
    return as_col(c).cast(MILLI)


def _may_be_number(c: Column) -> Column:
    """False for text the decimal cast must reject: empty, or a first character that cannot
    start a number (the cast trims whitespace/control characters, then wants a sign, digit or
    point). Skipping those avoids the cast's exception-based failure path, which is slow."""
    first = F.ascii(c)
    return (c != F.lit("")) & ((first <= 32) | first.isin(43, 45, 46) | first.between(48, 57))


def amount_from_text(c: Column | str) -> Column:
    """Spreadsheet text -> milli; anything that is not a plain number becomes 0.

    ``''``, ``'$5'`` and ``'1,234.50'`` all give 0, as the reference's cast does. Blank cells are seen before
    any pattern is tried. Plain amounts of up to eleven digits are read as integers without their point;
    decimal arithmetic, several times slower, reads the others.
    """
    text = as_col(c)
    zero = F.lit(0).cast(MILLI)
    parsed = (text.try_cast(TEXT_AMOUNT) * F.lit(1000).cast("decimal(4,0)")).cast(MILLI)
    point = F.instr(text, ".")
    places = F.when(point == 0, 0).otherwise(F.length(text) - point)
    plain = (F.replace(text, F.lit("."), F.lit("")).try_cast(MILLI)
             * F.when(places == 2, 10).when(places == 0, 1000).when(places == 1, 100).otherwise(1))
    return (F.when(text == F.lit(""), zero)
            .when(text.rlike(PLAIN_AMOUNT), plain)
            .when(_may_be_number(text), F.coalesce(parsed, zero)).otherwise(zero))


def round_milli(c: Column | str, digits: int) -> Column:
    """Round a milli amount to ``digits`` decimal places (0..3), half away from zero.

    The same rule as decimal ``round`` in Spark and in the reference's engine.
    """
    if not 0 <= digits <= 3:
        raise ValueError("digits must be between 0 and 3")
    step = 10 ** (3 - digits)
    col = as_col(c)
    if step == 1:
        return col
    shifted = F.abs(col) + F.lit(step // 2)
    rounded = shifted - F.pmod(shifted, F.lit(step))
    return F.when(col < 0, -rounded).otherwise(rounded)


def to_units(c: Column | str) -> Column:
    """Milli -> DOUBLE units (correctly rounded: exact integer divided by 1000)."""
    return as_col(c).cast("double") / F.lit(1000.0)
