"""Every operator and query as a (Spark callable, DuckDB oracle SQL) pair.

Each Spark callable takes (spark, sf_dir), reads the driver's tables there
(through the fixture derivation of ``curbline.sources.fixtures``) and returns
a DataFrame over the whole tables. The SQL text runs in DuckDB over the same
tables. Column names match on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.functions import (
    number_part, ols_slope, ols_slope_long, recode_county, rounded,
    strip_letters, upper_street, year_parsed, year_text,
)
from curbline.operators import (
    ADDRESS_KEYS, branch, clean_facts, clean_segments, count_long, dedupe_labels, distinct_ids,
    drop_null_facts, fill_zero, match, match_inner, match_outer, matchable,
    match_pairs, match_stored_ranges, match_totals, max_merge, pivot_outer, pivot_years, project_facts, range_counts, read_rejects, reject_malformed,
    segment_sides, segments_with_counts, split_malformed, store_events, store_sides, sum_by_id, union_branches, zero_rows,
)
from curbline.operators.match import plan_match, probe_rows
from curbline.plans import oracle as O
from curbline.plans import reports
from curbline.schemas import VIOLATION_CSV_COLUMNS, VIOLATION_CSV_POSITIONS, year_columns
from curbline.sources import csv as csv_io
from curbline.sources import fixtures

Y = fixtures.FIXTURE_YEARS
YC = year_columns(Y)
PAIR = ["vid", "seg_ord", "physical_id"]

SparkFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, SparkFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: SparkFn) -> SparkFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _v(spark, d):
    return fixtures.violations(spark, d)


def _s(spark, d):
    return fixtures.segments(spark, d)


def _facts(spark, d, **kw):
    return clean_facts(_v(spark, d), **{"years": Y, **kw})


def _sides(spark, d, drop_nulls=True, strict=False):
    return segment_sides(clean_segments(_s(spark, d), drop_nulls), strict)


FX = (O.FX_VIOLATION, O.FX_SEGMENT)
YSEL = ", ".join(YC)

# ---------------------------------------------------------------- sources


@register("scan_csv_facts", O.with_(*FX) + "SELECT * FROM fx_violation")
def q_scan_csv_facts(spark, d):
    path = csv_io.write_violations_csv(_v(spark, d), csv_io.fresh_path(spark, "facts-csv"))
    return csv_io.read_violations_csv(spark, path)


@register("scan_csv_by_position", O.with_(*FX) + "SELECT * FROM fx_violation")
def q_scan_csv_by_position(spark, d):
    # the public layout: used fields at fixed positions among others
    cells = [F.lit("x").alias(f"field {i}") for i in range(25)]
    for name, at in VIOLATION_CSV_POSITIONS.items():
        cells[at] = F.col(name).cast("string").alias(f"field {at}")
    path = csv_io.fresh_path(spark, "facts-layout-csv")
    _v(spark, d).select(*cells).write.option("header", "true").option("escape", '"').csv(path)
    return csv_io.read_violations_csv(spark, path, by_position=True)


@register("scan_csv_mixed_headers", O.with_(*FX) + "SELECT * FROM fx_violation")
def q_scan_csv_mixed_headers(spark, d):
    # two yearly folders: other column order, and a column more
    path, v = csv_io.fresh_path(spark, "facts-mixed-csv"), _v(spark, d)
    csv_io.write_violations_csv(v.where("vid % 2 = 0"), f"{path}/even")
    names = {k: c for c, k in VIOLATION_CSV_COLUMNS.items()}
    (v.where("vid % 2 <> 0 OR vid IS NULL")
     .select(F.lit("NY").alias("Plate State"), *[F.col(c).alias(names[c]) for c in reversed(v.columns)])
     .write.option("header", "true").option("escape", '"').csv(f"{path}/odd"))
    return csv_io.read_violations_csv(spark, path)


@register("scan_csv_split_multiline", O.with_(*FX) + "SELECT * FROM fx_violation")
def q_scan_csv_split_multiline(spark, d):
    # a remark with line breaks, quotes and commas stands between the used columns
    path, names = csv_io.fresh_path(spark, "facts-lines-csv"), {k: c for c, k in VIOLATION_CSV_COLUMNS.items()}
    remark = F.concat_ws("", F.lit('first "line", \r\n'), F.col("street_name"), F.lit('\n"\n\n,'), F.col("vid").cast("string"))
    v = _v(spark, d)
    cells = [F.col(c).alias(names[c]) for c in v.columns]
    (v.select(*cells[:2], remark.alias("Remark"), *cells[2:])
     .write.option("header", "true").option("escape", '"').csv(path))
    return csv_io.read_violations_csv(spark, path, multi_line="split")


@register("scan_csv_segments", O.with_(*FX) + "SELECT * FROM fx_segment")
def q_scan_csv_segments(spark, d):
    path = csv_io.write_segments_csv(_s(spark, d), csv_io.fresh_path(spark, "segments-csv"))
    return csv_io.read_segments_csv(spark, path)


# ---------------------------------------------------------------- facts: filters, projections

@register("drop_null_facts", O.with_(*FX) + """SELECT * FROM fx_violation
WHERE house_number IS NOT NULL AND street_name IS NOT NULL AND county IS NOT NULL
  AND issue_date IS NOT NULL""")
def q_drop_null_facts(spark, d):
    return drop_null_facts(_v(spark, d))


@register("project_facts", O.with_(*FX) + """SELECT house_number, street_name, county, issue_date
FROM fx_violation WHERE house_number IS NOT NULL AND street_name IS NOT NULL
  AND county IS NOT NULL AND issue_date IS NOT NULL""")
def q_project_facts(spark, d):
    return project_facts(_v(spark, d), keep_id=False)


FACT_COLS = "vid, street, house, county, boro, n1, n2, coalesce(n2, n1) % 2 AS parity, year"


@register("clean_facts", O.with_(*FX, O.facts_cte()) + f"SELECT {FACT_COLS} FROM facts")
def q_clean_facts(spark, d):
    return _facts(spark, d)


@register("sql_year_filter", O.with_(*FX, O.facts_cte()) +
          "SELECT vid, street, boro, n1, n2, year FROM facts")
def q_sql_year_filter(spark, d):
    # the view has no name in the session: two calls cannot collide
    return spark.sql(f"SELECT vid, street, boro, n1, n2, year FROM {{facts}} "
                     f"WHERE year >= {min(Y)} AND year <= {max(Y)}", facts=clean_facts(_v(spark, d)))


@register("recode_county", O.with_(*FX) + f"""SELECT vid, county AS county_raw,
  {O.county_case('county', 'final')} AS county FROM fx_violation""")
def q_recode_county(spark, d):
    return _v(spark, d).select("vid", F.col("county").alias("county_raw"),
                               recode_county("county", "final").alias("county"))


@register("recode_county_strict", O.with_(*FX) + f"""SELECT vid, county_raw, boro FROM (
  SELECT vid, county AS county_raw,
    {O.strict_int(O.county_case('county', 'no_pbx'))} AS boro FROM fx_violation)
WHERE boro IS NOT NULL""")
def q_recode_county_strict(spark, d):
    from curbline.functions import borough_code
    return (_v(spark, d)
            .select("vid", F.col("county").alias("county_raw"),
                    borough_code("county", "no_pbx").alias("boro"))
            .where(F.col("boro").isNotNull()))


@register("reject_malformed", O.with_(*FX) + f"""SELECT vid, boro, n1, n2, year FROM (
  SELECT vid,
    {O.strict_int(O.county_case('county', 'no_pbx'))} AS boro,
    {O.part_int("regexp_replace(house_number, '[A-Z]', '', 'g')", '-', 1)} AS n1,
    {O.part_int("regexp_replace(house_number, '[A-Z]', '', 'g')", '-', 2)} AS n2,
    CAST(year(try_strptime(issue_date, '%m/%d/%Y')) AS INTEGER) AS year
  FROM fx_violation
  WHERE house_number <> '' AND street_name <> '' AND county <> '' AND issue_date <> '')
WHERE boro IS NOT NULL AND n1 IS NOT NULL AND year IS NOT NULL""")
def q_reject_malformed(spark, d):
    return reject_malformed(_v(spark, d))


REASON_SQL = f"""SELECT vid, CASE
    WHEN house_number IS NULL OR street_name IS NULL OR county IS NULL OR issue_date IS NULL THEN 'missing field'
    WHEN house_number = '' OR street_name = '' OR county = '' OR issue_date = '' THEN 'empty field'
    WHEN {O.strict_int(O.county_case('county', 'no_pbx'))} IS NULL THEN 'unknown county'
    WHEN {O.part_int("regexp_replace(house_number, '[A-Z]', '', 'g')", '-', 1)} IS NULL THEN 'bad house number'
    WHEN year(try_strptime(issue_date, '%m/%d/%Y')) IS NULL THEN 'bad date' END AS reason
  FROM fx_violation"""


@register("reject_table", O.with_(*FX) + f"SELECT vid, reason FROM ({REASON_SQL}) WHERE reason IS NOT NULL")
def q_reject_table(spark, d):
    path = csv_io.fresh_path(spark, "judged")
    split_malformed(_v(spark, d), path)
    return read_rejects(spark, path).select("vid", "reason")


@register("reject_counts", O.with_(*FX) + f"""SELECT coalesce(reason, 'kept') AS reason, count(*) AS n
FROM ({REASON_SQL}) GROUP BY ALL""")
def q_reject_counts(spark, d):
    # the counts observed while the rows are written
    path = csv_io.fresh_path(spark, "judged")
    seen = split_malformed(_v(spark, d), path)
    return spark.createDataFrame([(k, n) for k, n in seen.items() if n], "reason string, n bigint")


# ---------------------------------------------------------------- scalar functions

@register("fn_upper", O.with_(*FX) + "SELECT vid, upper(street_name) AS street FROM fx_violation")
def q_fn_upper(spark, d):
    return _v(spark, d).select("vid", upper_street("street_name").alias("street"))


@register("fn_strip_letters", O.with_(*FX) +
          "SELECT vid, regexp_replace(house_number, '[A-Z]', '', 'g') AS house FROM fx_violation")
def q_fn_strip_letters(spark, d):
    return _v(spark, d).select("vid", strip_letters("house_number").alias("house"))


@register("fn_split_house", O.with_(*FX) + f"""SELECT vid,
  {O.part_int("regexp_replace(house_number, '[A-Z]', '', 'g')", '-', 1)} AS n1,
  {O.part_int("regexp_replace(house_number, '[A-Z]', '', 'g')", '-', 2)} AS n2
FROM fx_violation""")
def q_fn_split_house(spark, d):
    h = strip_letters("house_number")
    return _v(spark, d).select("vid", number_part(h, 0).alias("n1"), number_part(h, 1).alias("n2"))


@register("fn_cast_string", O.with_(*FX) + """SELECT seg_ord,
  CAST(physical_id AS VARCHAR) AS physical_id_text, CAST(boro_code AS VARCHAR) AS boro_text
FROM fx_segment""")
def q_fn_cast_string(spark, d):
    return _s(spark, d).select("seg_ord", F.col("physical_id").cast("string").alias("physical_id_text"),
                               F.col("boro_code").cast("string").alias("boro_text"))


@register("fn_year_text", O.with_(*FX) +
          f"SELECT vid, {O.part_int('issue_date', '/', 3)} AS year FROM fx_violation")
def q_fn_year_text(spark, d):
    return _v(spark, d).select("vid", year_text("issue_date").alias("year"))


@register("fn_year_parsed", O.with_(*FX) + """SELECT vid,
  CAST(year(try_strptime(issue_date, '%m/%d/%Y')) AS INTEGER) AS year FROM fx_violation""")
def q_fn_year_parsed(spark, d):
    return _v(spark, d).select("vid", year_parsed("issue_date").alias("year"))


# ---------------------------------------------------------------- trend on orders

ORDERS_WIDE = f"""orders_wide AS (
  SELECT o_custkey, {', '.join(f"count(*) FILTER (WHERE year(o_orderdate) = {y}) AS y{y}" for y in Y)}
  FROM orders GROUP BY o_custkey)"""


def _orders_wide(spark, d):
    o = fixtures.table(spark, d, "orders").select("o_custkey", F.year("o_orderdate").alias("year"))
    return pivot_years(o, ["o_custkey"], Y)


@register("ols_slope_wide", O.with_(ORDERS_WIDE) +
          f"SELECT o_custkey, {YSEL}, {O.round_sql(O.slope_sql(YC), 7)} AS ols_coeff FROM orders_wide")
def q_ols_slope_wide(spark, d):
    w = _orders_wide(spark, d)
    return w.select("o_custkey", *YC, rounded(ols_slope(YC, Y), 7).alias("ols_coeff"))


@register("fn_round", O.with_(ORDERS_WIDE) + f"""SELECT o_custkey,
  {O.round_sql(O.slope_sql(YC), 0)} AS slope_r0, {O.round_sql(O.slope_sql(YC), 3)} AS slope_r3,
  {O.round_sql(O.slope_sql(YC), 7)} AS slope_r7 FROM orders_wide""")
def q_fn_round(spark, d):
    s = ols_slope(YC, Y)
    return _orders_wide(spark, d).select(
        "o_custkey", rounded(s, 0).alias("slope_r0"), rounded(s, 3).alias("slope_r3"),
        rounded(s, 7).alias("slope_r7"))


@register("ols_slope_long", O.with_(ORDERS_WIDE) + f"""SELECT o_custkey,
  {O.round_sql('regr_slope(cnt, year)', 7)} AS ols_coeff
FROM (UNPIVOT orders_wide ON {YSEL} INTO NAME yname VALUE cnt)
  CROSS JOIN LATERAL (SELECT CAST(substr(yname, 2) AS INTEGER) AS year)
GROUP BY o_custkey""")
def q_ols_slope_long(spark, d):
    # wide -> long by a generator (keeps the partitioning by o_custkey, so the
    # regression aggregate needs no second shuffle)
    w = _orders_wide(spark, d)
    pairs = F.explode(F.array(*[F.struct(F.lit(y).alias("year"), F.col(c).alias("cnt"))
                                for y, c in zip(Y, YC)]))
    long = w.select("o_custkey", pairs.alias("p")).select("o_custkey", "p.year", "p.cnt")
    return long.groupBy("o_custkey").agg(
        rounded(ols_slope_long("cnt", "year"), 7).alias("ols_coeff"))


# ---------------------------------------------------------------- segments

SEG_COLS = ", ".join(
    ["seg_ord", "physical_id", "boro_code", "full_street", "st_label"]
    + [f"{b}_{i}" for b in ("l_low_hn", "l_high_hn", "r_low_hn", "r_high_hn") for i in (1, 2, 0)])


@register("clean_segments", O.with_(*FX, O.segs_cte()) + f"SELECT {SEG_COLS} FROM segs")
def q_clean_segments(spark, d):
    return clean_segments(_s(spark, d))


@register("dedupe_labels", O.with_(*FX, O.segs_cte()) + """SELECT seg_ord, physical_id, full_street AS street FROM segs
UNION ALL
SELECT seg_ord, physical_id, st_label AS street FROM segs WHERE st_label <> full_street""")
def q_dedupe_labels(spark, d):
    return dedupe_labels(clean_segments(_s(spark, d)))


@register("distinct_ids", O.with_(*FX) + "SELECT DISTINCT physical_id FROM fx_segment")
def q_distinct_ids(spark, d):
    return distinct_ids(_s(spark, d))


@register("zero_rows_for_ids", O.with_(*FX) +
          f"SELECT physical_id, {', '.join(f'0 AS {c}' for c in YC)} FROM (SELECT DISTINCT physical_id FROM fx_segment)")
def q_zero_rows_for_ids(spark, d):
    return zero_rows(distinct_ids(_s(spark, d)), YC)


# ---------------------------------------------------------------- predicates

@register("parity_split", O.with_(*FX, O.facts_cte(years=None)) + """SELECT vid, n1, n2,
  coalesce(n2, n1) % 2 AS parity,
  CASE coalesce(n2, n1) % 2 WHEN 0 THEN 'R' WHEN 1 THEN 'L' END AS side FROM facts""")
def q_parity_split(spark, d):
    f = clean_facts(_v(spark, d))
    side = F.when(F.col("parity") == 0, "R").when(F.col("parity") == 1, "L")
    return f.select("vid", "n1", "n2", "parity", side.alias("side"))


@register("simple_vs_compound", O.with_(*FX, O.facts_cte(years=None)) + """SELECT vid,
  CASE WHEN n1 IS NULL THEN 'invalid' WHEN n2 IS NULL THEN 'simple' ELSE 'compound' END AS kind
FROM facts""")
def q_simple_vs_compound(spark, d):
    f = clean_facts(_v(spark, d))
    kind = (F.when(F.col("n1").isNull(), "invalid")
            .when(F.col("n2").isNull(), "simple").otherwise("compound"))
    return f.select("vid", kind.alias("kind"))


# ---------------------------------------------------------------- joins

def _ticket_matches(spark, d, aliases="final", policy="all"):
    facts = matchable(_facts(spark, d, aliases=aliases)).select("vid", "boro", "street", "parity", "n1", "n2")
    return match(facts, _sides(spark, d), policy) if policy == "first" else match_pairs(facts, _sides(spark, d))


BRANCH_SQL = O.with_(*FX, O.facts_cte(), O.segs_cte()) + "SELECT * FROM (" + O.branches(
    "facts", "segs", "f.vid, s.seg_ord, s.physical_id") + ")"


@register("range_predicate", BRANCH_SQL.replace("SELECT * FROM", "SELECT vid, seg_ord, physical_id FROM", 1))
def q_range_predicate(spark, d):
    return _ticket_matches(spark, d).select(*PAIR)


_BRANCH_KEYS = {
    1: "join_simple_right_full", 2: "join_simple_right_label",
    3: "join_simple_left_full", 4: "join_simple_left_label",
    5: "join_compound_right_full", 6: "join_compound_right_label",
    7: "join_compound_left_full", 8: "join_compound_left_label",
}


def _branch_query(no: int) -> SparkFn:
    def fn(spark, d):
        return branch(_ticket_matches(spark, d), no).select(*PAIR)
    fn.__name__ = f"q_{_BRANCH_KEYS[no]}"
    return fn


for _no, _key in _BRANCH_KEYS.items():
    register(_key, BRANCH_SQL.replace("SELECT * FROM", "SELECT vid, seg_ord, physical_id FROM", 1)
             + f" WHERE branch = {_no}")(_branch_query(_no))


@register("union_branches", BRANCH_SQL.replace("SELECT * FROM", "SELECT vid, seg_ord, physical_id, branch FROM", 1))
def q_union_branches(spark, d):
    facts = matchable(_facts(spark, d)).select("vid", "boro", "street", "parity", "n1", "n2")
    return union_branches(facts, _sides(spark, d)).select(*PAIR, "branch")


@register("or_label_match", BRANCH_SQL.replace(
    "SELECT * FROM", "SELECT vid, seg_ord, physical_id, CASE WHEN branch % 2 = 1 THEN 'full' ELSE 'label' END AS name_role FROM", 1))
def q_or_label_match(spark, d):
    return _ticket_matches(spark, d).select(*PAIR, "name_role")


@register("match_all", O.with_(*FX, O.facts_cte(), O.segs_cte()) + f"""SELECT physical_id, year, CAST(count(*) AS BIGINT) AS cnt FROM (
{O.branches('facts', 'segs', 'f.year, s.physical_id')}) GROUP BY physical_id, year""")
def q_match_all(spark, d):
    return reports.counts_per_id_year(matchable(_facts(spark, d)), _sides(spark, d))


@register("match_colocated", O.with_(*FX, O.facts_cte(), O.segs_cte()) + f"""SELECT physical_id, year, CAST(count(*) AS BIGINT) AS cnt FROM (
{O.branches('facts', 'segs', 'f.year, s.physical_id')}) GROUP BY physical_id, year""")
def q_match_colocated(spark, d):
    # events are stored as counts per address and year, sides as distinct ranges
    facts, sides = count_long(matchable(_facts(spark, d)), [*ADDRESS_KEYS, "year"]), _sides(spark, d)
    events, stored_sides = _new_table(spark, "events"), _new_table(spark, "sides")
    plan = plan_match(probe_rows(sides, ["physical_id"]), broadcast=False)
    stored = store_events(facts, plan, events[0], salt="auto", path=events[1])
    store_sides(sides, stored, stored_sides[0], path=stored_sides[1], ranges=True)
    return range_counts(match_stored_ranges(spark, events[0], stored_sides[0]), sides, "physical_id", ["year"])


def _new_table(spark, label):
    """Name and folder of a table of one run."""
    path = csv_io.fresh_path(spark, f"stored-{label}")
    return "curbline_" + path.rsplit("/", 1)[1].replace("-", "_"), path


_NO_ST = O.with_(*FX, O.facts_cte(variant="no_st"), O.segs_cte())


@register("match_inner_or", _NO_ST + f"""SELECT vid, physical_id, year FROM (
{O.branches('facts', 'segs', 'f.vid, s.physical_id, f.year')})""")
def q_match_inner_or(spark, d):
    return match_inner(_events(spark, d), _sides(spark, d)).select("vid", "physical_id", "year")


def _events(spark, d):
    return matchable(_facts(spark, d, aliases="no_st")).select("vid", "year", *ADDRESS_KEYS)


_OUTER_CTES = _NO_ST + f""", m AS (
{O.branches('facts', 'segs', 's.seg_ord, s.physical_id, f.vid, f.year')}),
oj AS (
  SELECT seg_ord, physical_id, vid, year FROM m
  UNION ALL
  SELECT seg_ord, physical_id, NULL AS vid, NULL AS year FROM segs
  WHERE seg_ord NOT IN (SELECT seg_ord FROM m))
"""
_OUTER_SQL = _OUTER_CTES + "SELECT seg_ord, physical_id, CAST(vid AS BIGINT) AS vid, CAST(year AS INTEGER) AS year FROM oj"


@register("match_outer_or", _OUTER_SQL)
def q_match_outer_or(spark, d):
    return match_outer(_events(spark, d), _sides(spark, d), clean_segments(_s(spark, d)))


_JOIN_OF_BRANCH = "CASE branch WHEN 1 THEN 1 WHEN 2 THEN 1 WHEN 3 THEN 2 WHEN 4 THEN 2 WHEN 5 THEN 3 WHEN 6 THEN 3 ELSE 4 END"


@register("match_outer_branches", _NO_ST + f""", m AS (
{O.branches('facts', 'segs', 's.seg_ord, s.physical_id, f.vid, f.year')}),
four AS (SELECT unnest([1, 2, 3, 4]) AS j),
hit AS (SELECT DISTINCT seg_ord, {_JOIN_OF_BRANCH} AS j FROM m)
SELECT seg_ord, physical_id, CAST(vid AS BIGINT) AS vid, CAST(year AS INTEGER) AS year FROM (
  SELECT seg_ord, physical_id, vid, year FROM m
  UNION ALL
  SELECT s.seg_ord, s.physical_id, NULL AS vid, NULL AS year FROM segs s, four
  WHERE NOT EXISTS (SELECT 1 FROM hit WHERE hit.seg_ord = s.seg_ord AND hit.j = four.j))""")
def q_match_outer_branches(spark, d):
    return match_outer(_events(spark, d), _sides(spark, d), clean_segments(_s(spark, d)), per="branch")


@register("match_first", O.with_(*FX, O.facts_cte(), O.segs_cte()) + f"""SELECT vid,
  min(seg_ord) AS seg_ord, arg_min(physical_id, seg_ord) AS physical_id FROM (
{O.branches('facts', 'segs', 'f.vid, s.seg_ord, s.physical_id')}) GROUP BY vid""")
def q_match_first(spark, d):
    return _ticket_matches(spark, d, policy="first").select(*PAIR)


_STRICT_FACTS = O.facts_cte(variant="no_pbx", year_mode="parsed", years=None, strict_county=True,
                            require_year=True)


@register("match_first_strict", O.with_(*FX, _STRICT_FACTS, O.segs_cte(drop_nulls=False)) + f"""SELECT vid,
  min(seg_ord) AS seg_ord, arg_min(physical_id, seg_ord) AS physical_id FROM (
{O.branches('facts', 'segs', 'f.vid, s.seg_ord, s.physical_id', strict=True)}) GROUP BY vid""")
def q_match_first_strict(spark, d):
    facts = matchable(clean_facts(_v(spark, d), None, "no_pbx", "parsed", strict_county=True))
    facts = facts.where(F.col("year").isNotNull()).select(
        "vid", "boro", "street", "parity", "n1", "n2")
    return match(facts, _sides(spark, d, drop_nulls=False, strict=True), "first").select(*PAIR)


# ---------------------------------------------------------------- aggregations

_PRE = O.with_(*FX, O.facts_cte(), O.segs_cte())
_PIVOT_NULL = ", ".join(f"CAST(NULLIF(count(*) FILTER (WHERE year = {y}), 0) AS BIGINT) AS y{y}" for y in Y)
_PIVOT_ZERO = ", ".join(f"count(*) FILTER (WHERE year = {y}) AS y{y}" for y in Y)


@register("pivot_preagg", _PRE + f"""SELECT county, street, house, n1, n2, {_PIVOT_NULL}
FROM facts GROUP BY county, street, house, n1, n2""")
def q_pivot_preagg(spark, d):
    return pivot_years(_facts(spark, d), ["county", "street", "house", "n1", "n2"], Y,
                       missing_as_null=True)


@register("zero_fill_years", _PRE + f"""SELECT county, street, house, n1, n2, {_PIVOT_ZERO}
FROM facts GROUP BY county, street, house, n1, n2""")
def q_zero_fill_years(spark, d):
    p = pivot_years(_facts(spark, d), ["county", "street", "house", "n1", "n2"], Y,
                    missing_as_null=True)
    return fill_zero(p, YC)


def _joined_wide(select: str = "s.physical_id") -> str:
    return _PRE + f""", pre AS (
  SELECT county, street, house, n1, n2, boro, {_PIVOT_NULL}
  FROM facts GROUP BY county, street, house, n1, n2, boro),
joined AS ({O.branches('pre', 'segs', select + ', ' + ', '.join(f'coalesce(f.{c}, 0) AS {c}' for c in YC))})"""


_JOINED_WIDE = _joined_wide()
_SUMS = f", sums AS (SELECT physical_id, {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in YC)} FROM joined GROUP BY physical_id)"


def _matched_wide(spark, d):
    facts = matchable(_facts(spark, d))
    addresses = pivot_years(facts, ADDRESS_KEYS, Y)
    return match_totals(addresses, _sides(spark, d), YC, ["physical_id"])


@register("sum_years_by_id", _JOINED_WIDE + _SUMS + f"\nSELECT physical_id, {YSEL} FROM sums")
def q_sum_years_by_id(spark, d):
    return sum_by_id(_matched_wide(spark, d), YC)


_MERGED = _SUMS + f""",
merged AS (
  SELECT physical_id, {', '.join(f'CAST(max({c}) AS BIGINT) AS {c}' for c in YC)} FROM (
    SELECT physical_id, {YSEL} FROM sums
    UNION ALL
    SELECT physical_id, {', '.join('0' for _ in YC)} FROM (SELECT DISTINCT physical_id FROM fx_segment))
  GROUP BY physical_id)"""


@register("max_merge_zero_rows", _JOINED_WIDE + _MERGED + f"\nSELECT physical_id, {YSEL} FROM merged")
def q_max_merge_zero_rows(spark, d):
    sums = sum_by_id(_matched_wide(spark, d), YC)
    return max_merge(sums, zero_rows(distinct_ids(_s(spark, d)), YC), YC)


@register("segments_left_fill", _joined_wide("s.seg_ord, s.physical_id") + f"""
SELECT s.seg_ord, s.physical_id, {', '.join(f'CAST(coalesce(sum(j.{c}), 0) AS BIGINT) AS {c}' for c in YC)}
FROM segs s LEFT JOIN joined j ON s.seg_ord = j.seg_ord GROUP BY s.seg_ord, s.physical_id""")
def q_segments_left_fill(spark, d):
    return segments_with_counts(matchable(_facts(spark, d)), _sides(spark, d), clean_segments(_s(spark, d)), Y)


@register("pivot_by_id", _OUTER_CTES + f"SELECT physical_id, {_PIVOT_ZERO} FROM oj GROUP BY physical_id")
def q_pivot_by_id(spark, d):
    return pivot_outer(_events(spark, d), _sides(spark, d), clean_segments(_s(spark, d)), Y).orderBy("physical_id")


@register("count_id_year", O.with_(*FX, _STRICT_FACTS, O.segs_cte(drop_nulls=False)) + f"""SELECT physical_id, year, CAST(count(*) AS BIGINT) AS cnt FROM (
  SELECT vid, any_value(year) AS year, arg_min(physical_id, seg_ord) AS physical_id FROM (
{O.branches('facts', 'segs', 'f.vid, f.year, s.seg_ord, s.physical_id', strict=True)})
  WHERE year IS NOT NULL GROUP BY vid)
GROUP BY physical_id, year""")
def q_count_id_year(spark, d):
    return reports.count_id_year(_v(spark, d), _s(spark, d))


# ---------------------------------------------------------------- whole reports

def _report_sql(variant: str, digits: int, ids: str | None) -> str:
    head = O.with_(*FX, O.facts_cte(variant=variant), O.segs_cte())
    body = _JOINED_WIDE[len(_PRE):]
    id_src = {"raw": "fx_segment", "clean": "segs"}.get(ids)
    if id_src is None:
        final = _SUMS + f"\nSELECT physical_id, {YSEL}, {O.round_sql(O.slope_sql(YC), digits)} AS ols_coeff FROM sums"
    else:
        merged = _MERGED.replace("FROM fx_segment)", f"FROM {id_src})")
        final = merged + f"\nSELECT physical_id, {YSEL}, {O.round_sql(O.slope_sql(YC), digits)} AS ols_coeff FROM merged"
    return head + body + final


@register("segment_trend_report", _report_sql("final", 7, "raw"))
def q_segment_trend_report(spark, d):
    return reports.trend_report(_v(spark, d), _s(spark, d), Y)


@register("segment_trend_report_r3", _report_sql("no_st", 3, "raw"))
def q_segment_trend_report_r3(spark, d):
    return reports.trend_report_r3(_v(spark, d), _s(spark, d), Y)


@register("trend_clean_segments", _report_sql("no_st", 3, "clean"))
def q_trend_clean_segments(spark, d):
    return reports.trend_clean_segments(_v(spark, d), _s(spark, d), Y)


@register("trend_matched_segments", _report_sql("no_st", 0, None))
def q_trend_matched_segments(spark, d):
    return reports.trend_matched_segments(_v(spark, d), _s(spark, d), Y)


@register("top50_by_id", _report_sql("no_st", 0, None) + " ORDER BY physical_id LIMIT 50")
def q_top50_by_id(spark, d):
    return reports.top_by_id(reports.trend_matched_segments(_v(spark, d), _s(spark, d), Y), 50)


# ---------------------------------------------------------------- sinks

@register("sink_csv_roundtrip", _report_sql("final", 7, "raw"))
def q_sink_csv_roundtrip(spark, d):
    report = reports.trend_report(_v(spark, d), _s(spark, d), Y)
    path = csv_io.fresh_path(spark, "report-csv")
    csv_io.write_report_csv(report, path, mode="errorifexists")
    return csv_io.read_report_csv(spark, path, Y)


@register("sink_csv_overwrite", _report_sql("no_st", 3, "raw"))
def q_sink_csv_overwrite(spark, d):
    path = csv_io.fresh_path(spark, "report-csv")
    # a first, different result is replaced by the second write
    csv_io.write_report_csv(reports.trend_report(_v(spark, d), _s(spark, d), Y), path, mode="overwrite")
    csv_io.write_report_csv(reports.trend_report_r3(_v(spark, d), _s(spark, d), Y), path, mode="overwrite")
    return csv_io.read_report_csv(spark, path, Y)


# ---------------------------------------------------------------- staging and incremental ingest

@register("stage_parquet_years", O.with_(*FX) + f"""SELECT * FROM fx_violation
WHERE {O.part_int('issue_date', '/', 3)} BETWEEN {min(Y)} AND {max(Y)}""")
def q_stage_parquet_years(spark, d):
    from curbline.sources import staging
    path = staging.stage_violations(_v(spark, d), csv_io.fresh_path(spark, "staged"))
    return staging.read_staged_violations(spark, path, Y)


@register("stream_ingest_facts", O.with_(*FX) + "SELECT * FROM fx_violation")
def q_stream_ingest_facts(spark, d):
    from curbline.sources import staging
    from curbline.streaming import ingest_violation_csvs
    src = csv_io.write_violations_csv(_v(spark, d), csv_io.fresh_path(spark, "arriving-csv"))
    out = csv_io.fresh_path(spark, "ingested")
    ingest_violation_csvs(spark, src, out, checkpoint=csv_io.fresh_path(spark, "ingest-ckpt"))
    return staging.read_staged_violations(spark, out).select(
        "vid", "house_number", "street_name", "county", "issue_date")


@register("stream_ingest_mixed", O.with_(*FX) + "SELECT * FROM fx_violation")
def q_stream_ingest_mixed(spark, d):
    from curbline.sources import staging
    from curbline.streaming import ingest_mixed_csvs
    # two kinds of files arrive in one folder, in batches of some files
    src, v = csv_io.fresh_path(spark, "arriving-mixed-csv"), _v(spark, d)
    names = {k: c for c, k in VIOLATION_CSV_COLUMNS.items()}
    csv_io.write_violations_csv(v.where("vid % 3 = 0"), f"{src}/a")
    (v.where("vid % 3 <> 0 OR vid IS NULL").select(F.lit("NY").alias("Plate State"), *[F.col(c).alias(names[c]) for c in reversed(v.columns)])
     .write.option("header", "true").option("escape", '"').csv(f"{src}/b"))
    out = csv_io.fresh_path(spark, "ingested-mixed")
    ingest_mixed_csvs(spark, src, out, checkpoint=csv_io.fresh_path(spark, "ingest-mixed-ckpt"), max_files_per_trigger=4)
    return staging.read_staged_violations(spark, out).select("vid", "house_number", "street_name", "county", "issue_date")
