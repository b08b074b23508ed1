"""Text labels: category-name cleanup, emoji removal, group-name splitting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from abacus.functions._col import as_col

# Fixed values that must match the reference's results.
# Characters a category label keeps; every other run of characters, white space too, becomes one space.
LABEL_CHARS_WITH_PLUS = r"[^\pL\pN.&/+]+"
LABEL_CHARS_NO_PLUS = r"[^\pL\pN.&/]+"
# Code points that are emoji by themselves (Unicode's Emoji property without digits, # and *, and
# without the letters of flags), in code-point order.
EMOJI = (
    "00A9 00AE 203C 2049 2122 2139 2194-2199 21A9-21AA 231A-231B 2328 23CF 23E9-23F3 23F8-23FA 24C2 25AA-25AB 25B6 25C0 "
    "25FB-25FE 2600-2604 260E 2611 2614-2615 2618 261D 2620 2622-2623 2626 262A 262E-262F 2638-263A 2640 2642 2648-2653 "
    "265F-2660 2663 2665-2666 2668 267B 267E-267F 2692-2697 2699 269B-269C 26A0-26A1 26A7 26AA-26AB 26B0-26B1 26BD-26BE "
    "26C4-26C5 26C8 26CE-26CF 26D1 26D3-26D4 26E9-26EA 26F0-26F5 26F7-26FA 26FD 2702 2705 2708-270D 270F 2712 2714 2716 "
    "271D 2721 2728 2733-2734 2744 2747 274C 274E 2753-2755 2757 2763-2764 2795-2797 27A1 27B0 27BF 2934-2935 2B05-2B07 "
    "2B1B-2B1C 2B50 2B55 3030 303D 3297 3299 1F004 1F0CF 1F170-1F171 1F17E-1F17F 1F18E 1F191-1F19A 1F201-1F202 1F21A 1F22F "
    "1F232-1F23A 1F250-1F251 1F300-1F321 1F324-1F393 1F396-1F397 1F399-1F39B 1F39E-1F3F0 1F3F3-1F3F5 1F3F7-1F4FD "
    "1F4FF-1F53D 1F549-1F54E 1F550-1F567 1F56F-1F570 1F573-1F57A 1F587 1F58A-1F58D 1F590 1F595-1F596 1F5A4-1F5A5 1F5A8 "
    "1F5B1-1F5B2 1F5BC 1F5C2-1F5C4 1F5D1-1F5D3 1F5DC-1F5DE 1F5E1 1F5E3 1F5E8 1F5EF 1F5F3 1F5FA-1F64F 1F680-1F6C5 "
    "1F6CB-1F6D2 1F6D5-1F6D7 1F6DC-1F6E5 1F6E9 1F6EB-1F6EC 1F6F0 1F6F3-1F6FC 1F7E0-1F7EB 1F7F0 1F90C-1F93A 1F93C-1F945 "
    "1F947-1F9FF 1FA70-1FA7C 1FA80-1FA89 1FA8F-1FAC6 1FACE-1FADC 1FADF-1FAE9 1FAF0-1FAF8"
)
# Group name that stands for income, and the separator between group and subgroup.
INCOME_GROUP_NAME = "Internal Master Category"
INCOME_LABEL = "Income"
GROUP_SEPARATOR = " - "


def clean_label(c: Column | str, keep_plus: bool) -> Column:
    """Replace disallowed characters by a space, collapse whitespace, trim.

    The categories table keeps ``+`` and the monthly table drops it, so the same
    name can be cleaned two ways (both are used by the reference).
    """
    pattern = LABEL_CHARS_WITH_PLUS if keep_plus else LABEL_CHARS_NO_PLUS
    return F.trim(F.regexp_replace(as_col(c), pattern, " "))


def _emoji_pattern() -> str:
    """Emoji and their sequences, longest first: keycaps, flags, tagged flags, and emoji with a
    variation selector or skin tone, joined to others by the zero-width joiner."""
    one = "[" + "".join("-".join(rf"\x{{{p}}}" for p in r.split("-")) for r in EMOJI.split()) + "]"
    styled = one + r"(?:\x{FE0F}\x{20E3}?|[\x{1F3FB}-\x{1F3FF}])?"
    return "|".join([r"[0-9#*]\x{FE0F}?\x{20E3}", r"[\x{1F1E6}-\x{1F1FF}]{2}", r"\x{1F3F4}[\x{E0020}-\x{E007E}]+\x{E007F}",
                     rf"{styled}(?:\x{{200D}}{styled})*"])


def strip_emoji(c: Column | str) -> Column:
    """``c`` without emoji, trimmed. Digits, letters and symbols that are no emoji stay."""
    return F.trim(F.regexp_replace(as_col(c), _emoji_pattern(), ""))


def split_part(c: Column | str, sep: str, index: int) -> Column:
    """0-based piece of ``c`` split on the literal ``sep``; NULL when out of range."""
    return F.get(F.split(as_col(c), r"\Q" + sep + r"\E"), index)


def group_mapping(c: Column | str, income_name: str = INCOME_GROUP_NAME,
                  income_label: str = INCOME_LABEL, sep: str = GROUP_SEPARATOR) -> Column:
    """Top-level group of a ``'Group - Subgroup'`` name; the income group maps to ``'Income'``."""
    name = as_col(c)
    return F.when(name == F.lit(income_name), F.lit(income_label)).otherwise(split_part(name, sep, 0))


def subgroup(c: Column | str, sep: str = GROUP_SEPARATOR) -> Column:
    return split_part(c, sep, 1)
