"""DuckDB SQL for the correctness oracle.

The oracle is written independently of the Spark plans and in the shape of
the original job: eight OR-free join branches unioned as a bag, a pivot with
FILTERed counts, a union with zero rows and a max per id. So every Spark
query is checked against the original formulation, not against itself.
Only the fixture derivation and the county alias table are shared.
"""

from __future__ import annotations

from collections.abc import Sequence

from curbline.functions.recode import alias_map
from curbline.sources.fixtures import FIXTURE_YEARS

Y = FIXTURE_YEARS

FX_VIOLATION = """fx_violation AS (
  SELECT o_orderkey AS vid,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL
         WHEN o_orderkey % 89 = 0 THEN 'N/A'
         WHEN o_orderkey % 83 = 0 THEN '12b'
         WHEN o_orderkey % 71 = 0 THEN concat(CAST(o_custkey % 60 + 1 AS VARCHAR), '.5')
         WHEN o_orderkey % 67 = 0 THEN '1e1'
         WHEN o_orderkey % 79 = 0 THEN concat(CAST(o_custkey % 60 + 1 AS VARCHAR), '-', CAST((o_orderkey + o_custkey) % 40 + 1 AS VARCHAR), '-9')
         WHEN o_orderkey % 7 < 3 THEN concat(CAST(o_custkey % 60 + 1 AS VARCHAR), '-', CAST((o_orderkey + o_custkey) % 40 + 1 AS VARCHAR))
         WHEN o_orderkey % 7 = 3 THEN concat(CAST(o_custkey % 60 + 1 AS VARCHAR), 'A')
         ELSE CAST(o_custkey % 60 + 1 AS VARCHAR) END AS house_number,
    concat(CASE WHEN o_orderkey % 2 = 0 THEN 'Main St ' ELSE 'main street ' END, CAST(o_orderkey % 11 AS VARCHAR)) AS street_name,
    CASE o_orderkey % 23
      WHEN 0 THEN 'MAN' WHEN 1 THEN 'MH' WHEN 2 THEN 'MN' WHEN 3 THEN 'NEWY' WHEN 4 THEN 'NEW Y' WHEN 5 THEN 'NY'
      WHEN 6 THEN 'BRONX' WHEN 7 THEN 'BX' WHEN 8 THEN 'PBX'
      WHEN 9 THEN 'BK' WHEN 10 THEN 'K' WHEN 11 THEN 'KING' WHEN 12 THEN 'KINGS'
      WHEN 13 THEN 'Q' WHEN 14 THEN 'QN' WHEN 15 THEN 'QNS' WHEN 16 THEN 'QU' WHEN 17 THEN 'QUEEN'
      WHEN 18 THEN 'R' WHEN 19 THEN 'RICHMOND' WHEN 20 THEN 'ST'
      WHEN 21 THEN 'ZZ' WHEN 22 THEN '1' END AS county,
    strftime(o_orderdate, '%m/%d/%Y') AS issue_date
  FROM orders)"""

FX_SEGMENT = """fx_segment AS (
  SELECT p_partkey AS seg_ord,
    CAST(floor(p_partkey / 2) AS BIGINT) AS physical_id,
    CAST(p_partkey % 5 + 1 AS INTEGER) AS boro_code,
    concat('Main St ', CAST(p_partkey % 11 AS VARCHAR)) AS full_street,
    CASE WHEN p_partkey % 3 = 0 THEN concat('main st ', CAST(p_partkey % 11 AS VARCHAR))
         ELSE concat('Main Street ', CAST((p_partkey + 4) % 11 AS VARCHAR)) END AS st_label,
    CASE WHEN CAST(floor(p_partkey / 2) AS BIGINT) % 29 = 7 THEN NULL
         WHEN p_partkey % 4 = 0 THEN concat(CAST(p_size AS VARCHAR), '-', CAST(p_size % 20 AS VARCHAR))
         ELSE CAST(p_size AS VARCHAR) END AS l_low_hn,
    CASE WHEN p_partkey % 4 = 0 THEN concat(CAST(p_size + 10 AS VARCHAR), '-', CAST(p_size % 20 + 15 AS VARCHAR)) ELSE CAST(p_size + 10 AS VARCHAR) END AS l_high_hn,
    CASE WHEN p_partkey % 4 = 0 THEN concat(CAST(p_size + 1 AS VARCHAR), '-', CAST(p_size % 20 + 1 AS VARCHAR)) ELSE CAST(p_size + 1 AS VARCHAR) END AS r_low_hn,
    CASE WHEN p_partkey % 4 = 0 THEN concat(CAST(p_size + 12 AS VARCHAR), '-', CAST(p_size % 20 + 18 AS VARCHAR)) ELSE CAST(p_size + 12 AS VARCHAR) END AS r_high_hn
  FROM part)"""


def strict_int(expr: str) -> str:
    """Text as INTEGER the way the original job's engine read it: digits with a
    sign, decimals cut off, nothing else (no exponents or underscores) but
    spaces around."""
    expr = f"trim({expr})"
    return (f"CASE WHEN regexp_full_match({expr}, '[+-]?([0-9]+([.][0-9]*)?|[.][0-9]*)') "
            f"THEN TRY_CAST(regexp_replace(regexp_replace({expr}, '[.].*$', ''), '^([+-]?)$', '\\1' || '0') AS INTEGER) END")


def part_int(expr: str, sep: str, index: int) -> str:
    """Part ``index`` (1-based) of ``expr`` as INTEGER; NULL when missing."""
    return strict_int(f"split_part({expr}, '{sep}', {index})")


def county_case(expr: str, variant: str) -> str:
    whens = " ".join(f"WHEN '{a}' THEN '{c}'" for a, c in alias_map(variant).items())
    return f"CASE {expr} {whens} ELSE {expr} END"


def year_cols(years: Sequence[int] = Y) -> list[str]:
    return [f"y{y}" for y in years]


def facts_cte(name: str = "facts", variant: str = "final", year_mode: str = "text",
              years: Sequence[int] | None = Y, strict_county: bool = False,
              require_year: bool = False) -> str:
    """Cleaned events: vid, street, house, county, boro, n1, n2, year."""
    if year_mode == "text":
        year = part_int("issue_date", "/", 3)
    else:
        year = "CAST(year(try_strptime(issue_date, '%m/%d/%Y')) AS INTEGER)"
    house = "regexp_replace(house_number, '[A-Z]', '', 'g')"
    where = []
    if years is not None:
        where.append(f"year >= {min(years)} AND year <= {max(years)}")
    if strict_county:
        where.append(f"{strict_int('county')} IS NOT NULL")
    if require_year:
        where.append("year IS NOT NULL")
    cond = ("WHERE " + " AND ".join(where)) if where else ""
    return f"""{name}_raw AS (
  SELECT vid, upper(street_name) AS street, {house} AS house,
    {county_case('county', variant)} AS county, {year} AS year
  FROM fx_violation
  WHERE house_number IS NOT NULL AND street_name IS NOT NULL
    AND county IS NOT NULL AND issue_date IS NOT NULL),
{name} AS (
  SELECT vid, street, house, county, {strict_int('county')} AS boro,
    {part_int('house', '-', 1)} AS n1, {part_int('house', '-', 2)} AS n2, year
  FROM {name}_raw {cond})"""


def segs_cte(name: str = "segs", drop_nulls: bool = True) -> str:
    """Cleaned segments with bounds split: x_1, x_2 and the whole x_0."""
    cols = []
    for b in ("l_low_hn", "l_high_hn", "r_low_hn", "r_high_hn"):
        cols += [f"{part_int(b, '-', 1)} AS {b}_1", f"{part_int(b, '-', 2)} AS {b}_2",
                 f"{strict_int(b)} AS {b}_0"]
    where = ("WHERE physical_id IS NOT NULL AND l_low_hn IS NOT NULL AND l_high_hn IS NOT NULL"
             " AND r_low_hn IS NOT NULL AND r_high_hn IS NOT NULL AND full_street IS NOT NULL"
             " AND st_label IS NOT NULL AND boro_code IS NOT NULL") if drop_nulls else ""
    return f"""{name} AS (
  SELECT seg_ord, physical_id, boro_code, upper(full_street) AS full_street,
    upper(st_label) AS st_label, {', '.join(cols)}
  FROM fx_segment {where})"""


def branches(facts: str, segs: str, select: str, strict: bool = False) -> str:
    """UNION ALL of the eight OR-free branches (simple/compound x R/L x full/label).

    ``select`` may use f.* and s.* and must not have a trailing comma.
    The label branches skip labels equal to the full name (counted once).
    ``strict`` compares simple numbers with the whole bound only.
    """
    out = []
    no = 0
    for compound in (False, True):
        for side, par in (("r", 0), ("l", 1)):
            for role in ("full", "label"):
                no += 1
                name_cond = ("f.street = s.full_street" if role == "full" else
                             "f.street = s.st_label AND s.st_label <> s.full_street")
                if not compound:
                    lo, hi = (f"s.{side}_low_hn_0", f"s.{side}_high_hn_0") if strict else \
                             (f"s.{side}_low_hn_1", f"s.{side}_high_hn_1")
                    rng = (f"f.n2 IS NULL AND f.n1 % 2 = {par} "
                           f"AND f.n1 >= {lo} AND f.n1 <= {hi}")
                else:
                    rng = (f"f.n2 IS NOT NULL AND f.n2 % 2 = {par} "
                           f"AND f.n2 >= s.{side}_low_hn_2 AND f.n2 <= s.{side}_high_hn_2 "
                           f"AND f.n1 >= s.{side}_low_hn_1 AND f.n1 <= s.{side}_high_hn_1")
                out.append(
                    f"SELECT {select}, {no} AS branch FROM {facts} f JOIN {segs} s "
                    f"ON {rng} AND f.boro = s.boro_code AND {name_cond}")
    return "\nUNION ALL\n".join(out)


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def slope_sql(cols: Sequence[str], years: Sequence[int] = Y) -> str:
    """Closed-form OLS slope with integer numerator, as the Spark side."""
    n, sx = len(years), sum(years)
    den = n * sum(x * x for x in years) - sx * sx
    terms = " + ".join(f"CAST({c} AS BIGINT) * ({n * x - sx})" for c, x in zip(cols, years))
    return f"CAST(({terms}) AS DOUBLE) / {float(den)}"


def round_sql(expr: str, digits: int) -> str:
    """Half-away-from-zero rounding; ``+ 0.0`` turns a -0.0 result into 0.0,
    as Spark's (decimal based) ``round`` returns."""
    return f"(round({expr}, {digits}) + 0.0)"
