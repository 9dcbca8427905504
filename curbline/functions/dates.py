"""Year extraction from 'MM/dd/yyyy' issue dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curbline.functions.house import parse_int


def year_text(c: Column | str) -> Column:
    """Third '/'-separated part as int (F7); NULL when absent or not a number."""
    col = F.col(c) if isinstance(c, str) else c
    return parse_int(F.get(F.split(col, "/"), F.lit(2)))


def year_parsed(c: Column | str) -> Column:
    """Year of a validated month/day/year date (F8); NULL when invalid.

    'M/d/yyyy' accepts one- and two-digit months and days, as a
    '%m/%d/%Y' parser does.
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.year(F.try_to_timestamp(col, F.lit("M/d/yyyy")))
