"""House-number and street parsing as native Column expressions.

All of these stay inside whole-stage codegen: no Python runs per row.
Under ANSI mode (the PySpark 4 default) ``getItem`` past the end and ``cast``
of bad text raise errors, so ``F.get`` and ``parse_int`` are used: a missing
part or an unparsable part is NULL, which later never matches.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_int(c: Column | str) -> Column:
    """Text as int the way Spark 2.4's cast read it (F5), NULL if it is no number.

    An optional sign and digits; a decimal part is cut off ('12.5' -> 12, '.5'
    and '.' -> 0). No exponents or other characters; out of range is NULL.
    Blanks around the number are ignored, as later Spark versions do.

    Two speeds: a plain cast reads whole numbers; only a text that the cast
    refuses meets the pattern, which cuts the decimal part off.
    """
    col = _col(c)
    # "$1" + "0" + "$2": a zero before the digits, as there may be none
    cut = F.regexp_replace(col, r"^\s*([+-]?)([0-9]*)[.][0-9]*\s*$", "$10$2")
    return F.coalesce(col.try_cast("int"), cut.try_cast("int"))


def upper_street(c: Column | str) -> Column:
    """Street names are compared upper-cased (F1)."""
    return F.upper(_col(c))


# Fixed value: the letters removed from house numbers (upper-case A-Z only).
UPPER_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def strip_letters(c: Column | str) -> Column:
    """Drop upper-case letters A-Z from a house number (F2): '12A' -> '12'.

    Lower-case letters stay, so '12b' later fails to parse and never matches.
    ``translate`` with an empty replacement deletes the characters: the same
    result as ``regexp_replace(c, '[A-Z]', '')`` without a regex per row.
    """
    return F.translate(_col(c), UPPER_LETTERS, "")


def number_part(c: Column | str, index: int) -> Column:
    """Part ``index`` (0 or 1) of a '-'-separated number, as int or NULL.

    '12-34' -> 12, 34; '12' -> 12, NULL; '1-2-3' -> 1, 2; '-7' -> NULL, 7.
    Same values as ``parse_int`` of ``get(split(c, '-'), index)``, with plain substring searches instead of a regex split.
    """
    col = _col(c)
    if index == 0:
        part = F.substring_index(col, "-", 1)
    elif index == 1:
        part = F.when(F.instr(col, "-") > 0,
                      F.substring_index(F.substring_index(col, "-", 2), "-", -1))
    else:
        part = F.get(F.split(col, "-"), F.lit(index))
    return parse_int(part)


def whole_number(c: Column | str) -> Column:
    """The whole text as an int; NULL for compound or malformed text."""
    return parse_int(c)


def parity(n1: Column | str, n2: Column | str) -> Column:
    """0 for even (right side), 1 for odd (left side).

    The parity of a compound number is that of its second part.
    """
    return F.coalesce(_col(n2), _col(n1)) % 2
