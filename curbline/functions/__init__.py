"""Column-level functions (JVM-side expressions only, no Python UDFs)."""

from curbline.functions.dates import year_parsed, year_text
from curbline.functions.house import (
    number_part, parity, parse_int, strip_letters, upper_street, whole_number,
)
from curbline.functions.recode import alias_map, borough_code, recode_county
from curbline.functions.trend import ols_slope, ols_slope_long, rounded

__all__ = [
    "alias_map", "borough_code", "number_part", "ols_slope", "ols_slope_long",
    "parity", "parse_int", "recode_county", "rounded", "strip_letters", "upper_street",
    "whole_number", "year_parsed", "year_text",
]
