"""The bucketed range join against a brute-force reading of the eight branches."""

import collections

import pytest
from pyspark.sql import functions as F

from given_tables import SF001
from curbline.operators import (
    branch, clean_facts, clean_segments, match, match_outer, matchable,
    segment_sides, union_branches,
)
from curbline.operators.match import match_unbucketed, plan_match, probe_rows
from curbline.sources import fixtures

Y = fixtures.FIXTURE_YEARS


def brute_pairs(facts, segs, strict=False):
    """All (vid, seg_ord) matches, checked branch by branch in plain Python."""
    out = []
    for f in facts:
        if f["boro"] is None or f["n1"] is None:
            continue
        for s in segs:
            if s["boro_code"] != f["boro"]:
                continue
            names = {s["full_street"], s["st_label"]} - {None}
            if f["street"] not in names:
                continue
            n1, n2 = f["n1"], f["n2"]
            side = "r" if (n2 if n2 is not None else n1) % 2 == 0 else "l"

            def b(name):
                return s[f"{side}_{name}"]
            if n2 is None:
                lo, hi = (b("low_hn_0"), b("high_hn_0")) if strict else (b("low_hn_1"), b("high_hn_1"))
                ok = lo is not None and hi is not None and lo <= n1 <= hi
            else:
                vals = [b("low_hn_1"), b("high_hn_1"), b("low_hn_2"), b("high_hn_2")]
                ok = None not in vals and vals[0] <= n1 <= vals[1] and vals[2] <= n2 <= vals[3]
            if ok:
                out.append((f["vid"], s["seg_ord"]))
    return out


@pytest.fixture(scope="module")
def small(spark):
    v = fixtures.violations(spark, SF001)
    s = fixtures.segments(spark, SF001)
    facts = matchable(clean_facts(v, Y)).select("vid", "boro", "street", "parity", "n1", "n2")
    return facts, s


def _pairs(df):
    return sorted((r["vid"], r["seg_ord"]) for r in df.select("vid", "seg_ord").collect())


@pytest.mark.parametrize("kw", [
    {},                                          # measured bucket width, broadcast
    {"broadcast": False},                        # shuffled equi-join
    {"broadcast": False, "salt": 4},             # salted shuffled join
    {"bucket_width": 1, "fanout": 2},            # many levels
    {"bucket_width": 3, "fanout": 3, "broadcast": False},
])
def test_match_all_equals_brute_force(spark, small, kw):
    facts, s = small
    seg = clean_segments(s)
    got = _pairs(match(facts, segment_sides(seg), "all", **kw))
    want = sorted(brute_pairs(facts.collect(), seg.collect()))
    assert got == want
    assert len(got) == 386        # matches of the sf0.001 fixture (policy all)


def test_strict_and_nulls_kept(spark, small):
    facts, s = small
    seg = clean_segments(s, drop_nulls=False)
    got = _pairs(match(facts, segment_sides(seg, strict=True), "all", bucket_width=2, fanout=2))
    assert got == sorted(brute_pairs(facts.collect(), seg.collect(), strict=True))


def test_first_policy(spark, small):
    facts, s = small
    seg = clean_segments(s)
    got = sorted((r["vid"], r["seg_ord"], r["physical_id"])
                 for r in match(facts, segment_sides(seg), "first").collect())
    by_vid = collections.defaultdict(list)
    for vid, so in brute_pairs(facts.collect(), seg.collect()):
        by_vid[vid].append(so)
    pid = {r["seg_ord"]: r["physical_id"] for r in seg.collect()}
    want = sorted((vid, min(v), pid[min(v)]) for vid, v in by_vid.items())
    assert got == want
    assert len(got) == 314        # events with at least one match at sf0.001


def test_unbucketed_agrees(spark, small):
    facts, s = small
    sides = segment_sides(clean_segments(s))
    assert _pairs(match(facts, sides, "all")) == _pairs(match_unbucketed(facts, sides))


def test_wide_and_nested_ranges(spark):
    """Ranges from 1 to 10^6 next to ranges of width 0: every pair once."""
    seg_rows = [
        (0, 100, 1, "A ST", "A ST", "1", "999999", "2", "1000000"),
        (1, 101, 1, "A ST", "A STREET", "11", "11", "12", "12"),
        (2, 102, 1, "A ST", "B ST", "1-1", "999-99", "2-2", "998-98"),
        (3, 103, 1, "A ST", "A ST", "5", "3", "6", "4"),          # empty ranges
        (4, 104, 1, "A ST", None, "101", "301", "100", "300"),
    ]
    seg = spark.createDataFrame(seg_rows, fixtures.segments(spark, SF001).schema)
    facts_rows = [(i, 1, "A ST", n1, n2) for i, (n1, n2) in enumerate(
        [(11, None), (12, None), (1, None), (999999, None), (1000000, None), (250, None),
         (3, 5), (999, 98), (999, 99), (4, None), (5, None), (0, None), (500, 50)])]
    facts = spark.createDataFrame(facts_rows, "vid long, boro int, street string, n1 int, n2 int") \
        .withColumn("parity", F.coalesce("n2", "n1") % 2)
    cs = clean_segments(seg, drop_nulls=False)
    want = sorted(brute_pairs(facts.collect(), cs.collect()))
    for kw in ({}, {"bucket_width": 1, "fanout": 2}, {"broadcast": False, "bucket_width": 2}):
        assert _pairs(match(facts, segment_sides(cs), "all", **kw)) == want, kw
    probe = probe_rows(segment_sides(cs))
    assert plan_match(probe, bucket_width=1, fanout=2).levels > 10


def test_one_wide_row_adds_one_level(spark):
    rows = [(i, i, 1, "A", 0, "R", "full", 10 * i, 10 * i + 9, None, None, None, None) for i in range(2000)]
    wide = [(9999, 9999, 1, "A", 0, "R", "full", 1, 99_999_999, None, None, None, None)]
    schema = ("seg_ord long, physical_id long, boro int, street string, parity int, side string, "
              "name_role string, s_lo int, s_hi int, lo1 int, hi1 int, lo2 int, hi2 int")
    tidy = plan_match(probe_rows(spark.createDataFrame(rows, schema)))
    dirty = plan_match(probe_rows(spark.createDataFrame(rows + wide, schema)))
    assert [len(x) for x in tidy.occupied] == [1, 0] and [len(x) for x in dirty.occupied] == [2, 0]


def test_narrow_second_parts_under_one_wide_first_part(spark):
    """10,000 compound ranges that all cover n1 1..500 and differ in n2: buckets in both dimensions."""
    from curbline.operators.match import bucketed_build
    schema = ("seg_ord long, physical_id long, boro int, street string, parity int, side string, "
              "name_role string, s_lo int, s_hi int, lo1 int, hi1 int, lo2 int, hi2 int")
    rows = [(i, i, 1, "A", 0, "R", "full", None, None, 1, 500, 4 * i, 4 * i + 2) for i in range(10_000)]
    rows += [(10_000, 10_000, 1, "A", 0, "R", "full", None, None, 7, 7, 0, 40_000), (10_001, 10_001, 1, "A", 0, "R", "full", 1, 500, 1, 500, 8, 8)]
    sides = spark.createDataFrame(rows, schema)
    flat, plan = plan_match(probe_rows(sides), second=False), plan_match(probe_rows(sides))
    assert flat.worst_load >= 10_000 and flat.width2 == 0
    assert plan.width2 and plan.worst_load <= 16 and plan.rows <= 17 * 5 * 2 * len(rows)
    assert bucketed_build(probe_rows(sides), plan).count() == plan.rows
    facts = spark.createDataFrame([(i, 1, "A", n1, n2, 0) for i, (n1, n2) in enumerate(
        [(3, 8), (7, 8), (500, 39_998), (501, 8), (7, 40_000), (9, None), (3, 7), (7, 3)])],
        "vid long, boro int, street string, n1 int, n2 int, parity int")
    want = sorted((f.vid, s[0]) for f in facts.collect() for s in rows
                  if (f.n2 is None and s[7] is not None and s[7] <= f.n1 <= s[8]) or
                  (f.n2 is not None and s[9] <= f.n1 <= s[10] and s[11] <= f.n2 <= s[12]))
    firsts = {}
    for v, o in want:
        firsts[v] = min(o, firsts.get(v, o))
    for kw in ({}, {"broadcast": False}, {"second": False}):
        assert _pairs(match(facts, sides, "all", **kw)) == want, kw
        assert {r.vid: r.seg_ord for r in match(facts, sides, "first", **kw).collect()} == firsts


def test_equal_events_are_matched_each(spark):
    """Three equal events, also with NULL ids: three first matches, on every path."""
    seg = segment_sides(clean_segments(spark.createDataFrame(
        [(7, 70, 1, "A ST", "A ST", "1", "9", "2", "10"), (8, 80, 1, "A ST", "A ST", "1", "9", "2", "10")],
        fixtures.segments(spark, SF001).schema)))
    facts = spark.createDataFrame([(None, 1, "A ST", 4, None, 0)] * 3 + [(5, 1, "A ST", 99, None, 1)],
                                  "vid long, boro int, street string, n1 int, n2 int, parity int")
    for kw in ({}, {"broadcast": False}, {"broadcast": False, "salt": 4}):
        assert [(r.vid, r.seg_ord, r.physical_id) for r in match(facts, seg, "first", **kw).collect()] == [(None, 7, 70)] * 3, kw
    none = match(facts, seg.limit(0), "first")
    assert none.collect() == [] and none.columns == [*facts.columns, "seg_ord", "physical_id"]


def test_first_match_moves_no_event_when_broadcast(spark, small):
    facts, s = small
    plan = match(facts, segment_sides(clean_segments(s)), "first")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(vid" not in plan and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_salt_splits_one_hot_address(spark):
    from curbline.operators.match import choose_salt
    hot = spark.range(20_000).selectExpr("id AS vid", "1 AS boro", "'A ST' AS street", "4 AS n1", "CAST(NULL AS INT) AS n2", "0 AS parity")
    assert choose_salt(hot, tasks=16) == 16
    even = hot.selectExpr("vid", "boro", "street", "CAST(vid AS INT) AS n1", "n2", "parity")
    assert choose_salt(even, tasks=16) == 1
    seg = segment_sides(clean_segments(spark.createDataFrame(
        [(7, 70, 1, "A ST", "A ST", "1", "9", "2", "10")], fixtures.segments(spark, SF001).schema)))
    joined = match(hot, seg, "all", broadcast=False, salt=16)
    assert joined.count() == 20_000
    spread = joined._jdf.queryExecution().analyzed().toString()
    assert "monotonically_increasing_id" in spread


def test_forced_broadcast_is_checked(spark, small):
    facts, s = small
    sides = segment_sides(clean_segments(s))
    spark.conf.set("curbline.broadcast.maxBytes", "1000")
    try:
        with pytest.raises(ValueError, match="maxBytes"):
            match(facts, sides, "all", broadcast=True)
        plan = match_unbucketed(facts, sides)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
    finally:
        spark.conf.unset("curbline.broadcast.maxBytes")


def test_size_bound_counts_bytes(spark):
    schema = ("seg_ord long, physical_id long, boro int, street string, parity int, side string, "
              "name_role string, s_lo int, s_hi int, lo1 int, hi1 int, lo2 int, hi2 int")

    def bound(street):
        rows = [(i, i, 1, street, 0, "R", "full", 1, 9, None, None, None, None) for i in range(10)]
        return plan_match(probe_rows(spark.createDataFrame(rows, schema))).size_bound

    assert bound("\u8857" * 200) >= bound("a" * 600) > bound("a" * 200)


def test_outer_forms(spark, small):
    facts, s = small
    seg = clean_segments(s)
    sides = segment_sides(seg)
    facts = facts.withColumn("year", F.lit(1995))
    pairs = match(facts, sides, "all")
    matched = {r.seg_ord for r in pairs.collect()}
    outer = match_outer(facts, sides, seg)
    assert outer.where("vid IS NULL").count() == seg.count() - len(matched)
    assert outer.where("vid IS NOT NULL").count() == pairs.count()
    four = pairs.select("seg_ord", F.col("n2").isNull().alias("k"), "side").distinct().count()
    bag = match_outer(facts, sides, seg, per="branch")
    assert bag.where("vid IS NULL").count() == 4 * seg.count() - four


def test_branches_partition_the_join(spark, small):
    facts, s = small
    sides = segment_sides(clean_segments(s))
    single = match(facts, sides, "all")
    counts = [branch(single, no).count() for no in range(1, 9)]
    assert counts == [107, 66, 105, 73, 19, 6, 7, 3]          # J1..J8 at sf0.001
    union = union_branches(facts, sides)
    assert _pairs(union) == _pairs(single)
    per_branch = dict(union.groupBy("branch").count().collect())
    assert [per_branch.get(no, 0) for no in range(1, 9)] == counts


def test_plan_is_broadcast_hash_join_without_python(spark, small):
    facts, s = small
    df = match(facts, segment_sides(clean_segments(s)), "all")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    shuffled = match(facts, segment_sides(clean_segments(s)), "all", broadcast=False)
    splan = shuffled._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in splan and "SortMergeJoin" in splan


def test_size_check_refuses_large_build(spark, small):
    facts, s = small
    probe = probe_rows(segment_sides(clean_segments(s)))
    spark.conf.set("curbline.broadcast.maxBytes", "1000")
    try:
        assert not plan_match(probe).broadcast
    finally:
        spark.conf.unset("curbline.broadcast.maxBytes")
    assert plan_match(probe).broadcast


def test_hot_key_third_of_rows(spark):
    """A third of all events at one address, half the segments on its street."""
    v = fixtures.violations(spark, SF001)
    hot = (F.col("vid") % 3 == 0)
    v = (v.withColumn("street_name", F.when(hot, F.lit("Main St 4")).otherwise(F.col("street_name")))
          .withColumn("house_number", F.when(hot, F.lit("24")).otherwise(F.col("house_number")))
          .withColumn("county", F.when(hot, F.lit("QNS")).otherwise(F.col("county"))))
    s = fixtures.segments(spark, SF001)
    s = (s.withColumn("full_street", F.when(F.col("seg_ord") % 2 == 0, F.lit("Main St 4"))
                      .otherwise(F.col("full_street")))
          .withColumn("boro_code", F.when(F.col("seg_ord") % 2 == 0, F.lit(4))
                      .otherwise(F.col("boro_code"))))
    facts = matchable(clean_facts(v, Y)).select("vid", "boro", "street", "parity", "n1", "n2")
    seg = clean_segments(s)
    want = sorted(brute_pairs(facts.collect(), seg.collect()))
    assert len(want) > 1000
    for kw in ({}, {"broadcast": False}, {"broadcast": False, "salt": 8}):
        assert _pairs(match(facts, segment_sides(seg), "all", **kw)) == want, kw
    # the trend report over the same skewed input equals the per-id brute-force sums
    from curbline.plans import reports
    rep = reports.trend_report(v, s, Y, broadcast=False, salt=4)
    total = rep.selectExpr("sum(y1995 + y1996 + y1997 + y1998 + y1999)").first()[0]
    assert total == len(want)


def test_size_bound_is_an_upper_bound(spark, small):
    from curbline.operators.match import bucketed_build
    facts, s = small
    probe = probe_rows(segment_sides(clean_segments(s)))
    plan = plan_match(probe)
    build = bucketed_build(probe, plan)
    rows = build.count()
    assert plan.size_bound >= rows * 100          # at least ~100 bytes per row counted
    assert plan.rows == rows


def test_rows_of_one_range_meet_an_address_once(spark):
    from curbline.operators import match_totals
    from curbline.operators.match import _first_per_range, match_ranges, probe_rows
    # 40 rows of two ranges: pairs are of addresses and ranges, whatever shares them
    sides = spark.createDataFrame(
        [(i, i // 2, 1, "A", 0, "R", "full", 2, 10 + 10 * (i % 2), 2, 9, 1, 5) for i in range(40)],
        "seg_ord long, physical_id long, boro int, street string, parity int, side string, name_role string, "
        "s_lo int, s_hi int, lo1 int, hi1 int, lo2 int, hi2 int")
    facts = spark.createDataFrame([(1, "A", 4, None, 0, 3), (1, "A", 14, None, 0, 5), (1, "A", 4, 4, 0, 7), (1, "B", 4, None, 0, 9)],
                                  "boro int, street string, n1 int, n2 int, parity int, cnt long")
    assert match_ranges(facts, sides).count() == 4
    assert _first_per_range(probe_rows(sides, ["seg_ord", "physical_id"])).count() == 3
    for options in ({}, {"broadcast": False}, {"broadcast": False, "salt": 3}):
        got = match_totals(facts, sides, ["cnt"], ["seg_ord"], **options).groupBy("seg_ord").agg(F.sum("cnt").alias("n"))
        want = match(facts, sides, "all", **options).groupBy("seg_ord").agg(F.sum("cnt").alias("n"))
        assert sorted(got.collect()) == sorted(want.collect()) and got.count() == 40
        first = match(facts, sides, "first", **options).select("n1", "n2", "seg_ord", "physical_id").collect()
        assert sorted(first, key=str) == sorted([(4, None, 0, 0), (14, None, 1, 0), (4, 4, 0, 0)], key=str)
