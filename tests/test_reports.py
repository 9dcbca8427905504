"""Whole reports: oracle agreement, zero rows, first-match counts, plan shape."""

import duckdb
import pytest

import __spark_entry__ as entry
from given_tables import SF001
from curbline.plans import registry, reports
from curbline.sources import fixtures

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def _norm(rows):
    return sorted((tuple(f"{v:.9g}" if isinstance(v, float) else v for v in r) for r in rows), key=repr)


def test_contract_keys_match():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(registry.QUERIES) == set(registry.ORACLE)
    assert set(registry.QUERIES) <= set(q) and set(o) <= set(q)
    assert len(registry.QUERIES) >= 59


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["physical_id", "y1995", "y1996", "y1997", "y1998", "y1999", "ols_coeff"]
    assert len(rows) == 100
    assert [r[0] for r in rows] == sorted(r[0] for r in rows)


@pytest.mark.parametrize("key", sorted(registry.ORACLE))
def test_every_key_against_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF001)
    s_rows = df.collect()
    res = duck.execute(entry.oracle_sql()[key])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    order = [d_cols.index(c) for c in df.columns]
    assert _norm(s_rows) == _norm([tuple(r[i] for i in order) for r in d_rows])


def test_zero_filled_ids(spark):
    v, s = fixtures.violations(spark, SF001), fixtures.segments(spark, SF001)
    rep = reports.trend_report(v, s, fixtures.FIXTURE_YEARS)
    zero = rep.where("y1995 + y1996 + y1997 + y1998 + y1999 = 0")
    # ids whose segment rows all had a NULL field still appear, with zeros
    assert zero.count() >= 5
    clean = reports.trend_clean_segments(v, s, fixtures.FIXTURE_YEARS)
    from curbline.operators import clean_segments
    dropped = (s.select("physical_id").distinct()
               .subtract(clean_segments(s).select("physical_id").distinct()).count())
    assert dropped == 4                                   # ids 7, 36, 65, 94
    assert rep.count() - clean.count() == dropped
    matched = reports.trend_matched_segments(v, s, fixtures.FIXTURE_YEARS)
    assert matched.where("y1995 + y1996 + y1997 + y1998 + y1999 = 0").count() == 0


def test_report_policy_all_counts_every_segment_row(spark):
    v, s = fixtures.violations(spark, SF001), fixtures.segments(spark, SF001)
    rep = reports.trend_report(v, s, fixtures.FIXTURE_YEARS)
    total = rep.selectExpr("sum(y1995 + y1996 + y1997 + y1998 + y1999)").first()[0]
    assert total == 386


def test_report_plan(spark):
    v, s = fixtures.violations(spark, SF001), fixtures.segments(spark, SF001)
    plan = reports.trend_report(v, s, fixtures.FIXTURE_YEARS)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "PythonUDF" not in plan and "EvalPython" not in plan


@pytest.mark.parametrize("make", [reports.trend_report, reports.trend_clean_segments,
                                  reports.trend_matched_segments])
def test_join_first_and_preaggregate_plans_agree(spark, make):
    v, s = fixtures.violations(spark, SF001), fixtures.segments(spark, SF001)
    a = make(v, s, fixtures.FIXTURE_YEARS, broadcast=True)
    b = make(v, s, fixtures.FIXTURE_YEARS, broadcast=False)
    c = make(v, s, fixtures.FIXTURE_YEARS, broadcast=False, salt=3)
    assert a.collect() == b.collect() == c.collect()
    assert "SortMergeJoin" in b._jdf.queryExecution().executedPlan().toString()


def test_counts_per_id_year_both_plans(spark):
    from curbline.operators import clean_facts, clean_segments, matchable, segment_sides
    v, s = fixtures.violations(spark, SF001), fixtures.segments(spark, SF001)
    facts = matchable(clean_facts(v, fixtures.FIXTURE_YEARS))
    sides = segment_sides(clean_segments(s))
    a = sorted(reports.counts_per_id_year(facts, sides, broadcast=True).collect())
    b = sorted(reports.counts_per_id_year(facts, sides, broadcast=False, salt=2).collect())
    assert a == b and sum(r["cnt"] for r in a) == 386


def test_pivot_years_equals_native_pivot(spark):
    from curbline.operators import clean_facts, pivot_years, pivot_years_native
    f = clean_facts(fixtures.violations(spark, SF001), fixtures.FIXTURE_YEARS)
    keys = ["county", "street", "house", "n1", "n2"]
    ours = pivot_years(f, keys, fixtures.FIXTURE_YEARS, missing_as_null=True)
    native = pivot_years_native(f, keys, fixtures.FIXTURE_YEARS)
    # one aggregate (one shuffle) instead of pivot's two; plans read before running
    plan = ours._jdf.queryExecution().executedPlan().toString()
    nplan = native._jdf.queryExecution().executedPlan().toString()
    assert sorted(ours.collect()) == sorted(native.select(*ours.columns).collect())
    assert plan.count("Exchange hashpartitioning") == 1
    assert nplan.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("strategy", ["auto", "join_first", "preaggregate"])
def test_strategies_agree(spark, strategy):
    v, s = fixtures.violations(spark, SF001), fixtures.segments(spark, SF001)
    want = reports.trend_report(v, s, fixtures.FIXTURE_YEARS, strategy="preaggregate").collect()
    got = reports.trend_report(v, s, fixtures.FIXTURE_YEARS, strategy=strategy).collect()
    assert got == want


SIDES = ("seg_ord long, physical_id long, boro int, street string, parity int, side string, "
         "name_role string, s_lo int, s_hi int, lo1 int, hi1 int, lo2 int, hi2 int")


def side(i, street, lo, hi):
    return (i, i, 1, street, 0, "R", "full", lo, hi, None, None, None, None)


def measured(spark, rows):
    from curbline.operators.match import plan_match, probe_rows
    return plan_match(probe_rows(spark.createDataFrame(rows, SIDES), ["physical_id"]))


def test_bucket_load(spark):
    tiles = measured(spark, [side(i, "A", 10 * i, 10 * i + 9) for i in range(50)])
    assert tiles.mean_load < 4 and reports.join_first(tiles, "auto")
    piled = measured(spark, [side(i, "A", 0, 9) for i in range(500)])
    assert piled.mean_load == pytest.approx(500) and piled.worst_load == 500
    assert not reports.join_first(piled, "auto")


def test_pile_behind_one_wide_row_forces_count_first(spark):
    """5,000 copies of one range and one row over the whole street: the average
    over the street is near 1, the fullest bucket is not."""
    rows = [side(j, "HOT", 0, 9) for j in range(5000)] + [side(5000, "HOT", 0, 999_999)]
    plan = measured(spark, rows)
    assert plan.worst_load >= 5000 and not reports.join_first(plan, "auto")
    # the same behind many tidy streets, where the mean over all buckets is low
    tidy = [side(9000 + i, f"S{i % 400}", 10 * (i // 400), 10 * (i // 400) + 9) for i in range(8000)]
    hidden = measured(spark, tidy + rows[:200])
    assert hidden.worst_load >= 200 and not reports.join_first(hidden, "auto")


def test_measured_plan_is_reused(spark):
    v, s = fixtures.violations(spark, SF001), fixtures.segments(spark, SF001)
    want = reports.trend_report(v, s, fixtures.FIXTURE_YEARS).collect()
    plan = reports.measure_segments(s)
    assert reports.trend_report(v, s, fixtures.FIXTURE_YEARS, plan=plan).collect() == want


@pytest.mark.parametrize("report", ["trend_report", "trend_report_r3", "trend_clean_segments", "trend_matched_segments", "count_id_year"])
def test_extreme_bounds_end_no_report(spark, report):
    v, s = fixtures.violations(spark, SF001), fixtures.segments(spark, SF001)
    columns = s.columns
    low = {"l_low_hn": "-7", "r_low_hn": "0", "l_high_hn": "2147483647", "r_high_hn": "2147483647"}
    dirty = s.limit(1).selectExpr(*[f"'{low[c]}' AS {c}" if c in low else ("CAST(999999 AS BIGINT) AS seg_ord" if c == "seg_ord" else c) for c in columns])
    rows = getattr(reports, report)(v, s.unionByName(dirty), fixtures.FIXTURE_YEARS).collect()
    assert rows


@pytest.mark.parametrize("strategy", ["join_first", "preaggregate"])
def test_checkpoint_cuts_lineage(spark, strategy):
    v, s = fixtures.violations(spark, SF001), fixtures.segments(spark, SF001)
    want = reports.trend_report(v, s, fixtures.FIXTURE_YEARS, strategy=strategy).collect()
    cut = reports.trend_report(v, s, fixtures.FIXTURE_YEARS, strategy=strategy, checkpoint=True)
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" in plan                    # reads the checkpointed table
    assert cut.collect() == want
