"""County recoding: free-form borough aliases -> borough codes '1'..'5'."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curbline.functions.house import parse_int

# --- Fixed values: these must equal the reference's alias tables exactly. ---
# Borough code -> aliases of the final version of the job.
COUNTY_ALIASES_BY_CODE: dict[str, tuple[str, ...]] = {
    "1": ("MAN", "MH", "MN", "NEWY", "NEW Y", "NY"),
    "2": ("BRONX", "BX", "PBX"),
    "3": ("BK", "K", "KING", "KINGS"),
    "4": ("Q", "QN", "QNS", "QU", "QUEEN"),
    "5": ("R", "RICHMOND", "ST"),
}
# The intermediate versions of the job lack 'ST'; the first version lacks 'PBX'.
ALIASES_WITHOUT = {"final": (), "no_st": ("ST",), "no_pbx": ("PBX",)}
# --- end of fixed values ---


def alias_map(variant: str = "final") -> dict[str, str]:
    """alias -> code for one of the variants 'final', 'no_st', 'no_pbx'."""
    left_out = ALIASES_WITHOUT[variant]
    return {
        alias: code
        for code, aliases in COUNTY_ALIASES_BY_CODE.items()
        for alias in aliases
        if alias not in left_out
    }


def recode_county(c: Column | str, variant: str = "final") -> Column:
    """Whole-value replacement; values that are not aliases pass unchanged.

    Same result as ``df.na.replace(dict, subset)``, written as one lookup in a
    literal map (constant-folded): compact generated code, one probe per row,
    and it composes with other column expressions.
    """
    col = F.col(c) if isinstance(c, str) else c
    pairs = []
    for alias, code in alias_map(variant).items():
        pairs += [F.lit(alias), F.lit(code)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col), col)


def borough_code(c: Column | str, variant: str = "final") -> Column:
    """Recoded county as int; unknown non-numeric values become NULL."""
    return parse_int(recode_county(c, variant))
