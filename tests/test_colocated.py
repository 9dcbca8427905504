"""Stored, bucketed tables: the same pairs as the plain match, and no exchange."""

import uuid

import pytest
from pyspark.sql import functions as F

from curbline.operators import (
    append_events, clean_facts, clean_segments, match, match_stored, matchable, segment_sides, store_events,
    store_sides, stored_plan,
)
from curbline.operators.match import plan_match, probe_rows
from curbline.sources import fixtures
from given_tables import SF001

Y = fixtures.FIXTURE_YEARS


@pytest.fixture(scope="module")
def given(spark):
    facts = matchable(clean_facts(fixtures.violations(spark, SF001), Y)).select(
        "vid", "boro", "street", "parity", "n1", "n2")
    return facts, segment_sides(clean_segments(fixtures.segments(spark, SF001)))


@pytest.fixture
def names(spark, tmp_path):
    made = []

    def new():
        made.append(f"t_{uuid.uuid4().hex}")
        return {"table": made[-1], "path": str(tmp_path / made[-1])}
    yield new
    for name in made:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def pairs(df):
    return sorted((r.vid, r.seg_ord) for r in df.select("vid", "seg_ord").collect())


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("salt,second", [(1, None), (3, None), ("auto", None), (1, True)])
def test_same_pairs_without_an_exchange(spark, given, names, salt, second):
    facts, sides = given
    e, s = names(), names()
    stored = store_events(facts, plan_match(probe_rows(sides), broadcast=False, second=second), buckets=5, salt=salt, **e)
    store_sides(sides, stored, **s)
    got = match_stored(spark, e["table"], s["table"])
    plan = physical(got)
    assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
    assert plan.count("SelectedBucketsCount: 5 out of 5") == 2 or "Bucketed: true" in plan
    want = match(facts, sides)
    assert got.columns == want.columns
    assert pairs(got) == pairs(want) != []
    first = match_stored(spark, e["table"], s["table"], "first")
    assert pairs(first) == pairs(match(facts, sides, "first"))


def test_appended_events_and_new_sides(spark, given, names):
    facts, sides = given
    e, s, later = names(), names(), names()
    stored = store_events(facts.where("vid % 2 = 0"), plan_match(probe_rows(sides), broadcast=False), buckets=4, salt=2, **e)
    store_sides(sides, stored, **s)
    assert append_events(facts.where("vid % 2 = 1"), e["table"]) == 1
    assert append_events(facts.limit(0), e["table"]) == 2
    assert append_events(facts.where("vid % 2 = 1"), e["table"]) == 2        # an empty batch leaves no row
    want = pairs(match(facts, sides))
    got = match_stored(spark, e["table"], s["table"])
    assert "Exchange" not in physical(got)
    assert pairs(got) == sorted(want + [p for p in want if p[0] % 2])
    firsts = pairs(match(facts, sides, "first"))
    assert pairs(match_stored(spark, e["table"], s["table"], "first")) == sorted(firsts + [p for p in firsts if p[0] % 2])
    # corrected segments are stored beside the old ones, with the events' plan
    fewer = sides.where("seg_ord % 3 <> 0")
    store_sides(fewer, stored_plan(spark, e["table"]), **later)
    assert set(pairs(match_stored(spark, e["table"], later["table"]))) == set(pairs(match(facts, fewer)))


def test_a_level_without_events_is_refused(spark, given, names):
    facts, sides = given
    stored = store_events(facts, plan_match(probe_rows(sides), broadcast=False), **names())
    wide = sides.withColumn("s_hi", F.lit(100_000_000)).withColumn("s_lo", F.lit(0))
    with pytest.raises(ValueError, match="needs a level"):
        store_sides(wide, stored, **names())
    only_simple = store_events(facts, plan_match(probe_rows(sides.withColumn("lo1", F.lit(None).cast("int"))), broadcast=False), **names())
    assert only_simple.occupied[1] == ()
    with pytest.raises(ValueError, match="no event is stored at the levels"):
        store_sides(sides, only_simple, **names())


def test_other_plans_and_other_tables_are_refused(spark, given, names):
    facts, sides = given
    e, s, plain = names(), names(), names()
    plan = plan_match(probe_rows(sides), broadcast=False)
    store_events(facts, plan, buckets=4, **e)
    other = names()
    store_sides(sides, store_events(facts, plan, buckets=3, **other), **s)
    with pytest.raises(ValueError, match="different plans"):
        match_stored(spark, e["table"], s["table"])
    facts.write.option("path", plain["path"]).saveAsTable(plain["table"])
    with pytest.raises(ValueError, match="not stored for"):
        match_stored(spark, plain["table"], s["table"])


def test_empty_tables_and_one_hot_address(spark, given, names):
    facts, sides = given
    plan = plan_match(probe_rows(sides), broadcast=False)
    e, s = names(), names()
    stored = store_events(facts.limit(0), plan, buckets=3, **e)
    store_sides(sides, stored, **s)
    assert match_stored(spark, e["table"], s["table"]).collect() == []
    one = match(facts, sides).select(*facts.columns).limit(1)
    hot = one.crossJoin(spark.range(600)).drop("id")        # equal events, one address
    h, t = names(), names()
    stored = store_events(hot, plan, buckets=6, salt="auto", **h)
    assert stored.salt == 6
    store_sides(sides, stored, **t)
    assert len({r[0] for r in spark.table(h["table"]).select(F.input_file_name()).distinct().collect()}) > 1
    assert pairs(match_stored(spark, h["table"], t["table"], "first")) == pairs(match(hot, sides, "first"))
    nothing = names(), names()
    stored = store_events(facts, plan_match(probe_rows(sides.limit(0)), broadcast=False), **nothing[0])
    store_sides(sides.limit(0), stored, **nothing[1])
    assert match_stored(spark, nothing[0]["table"], nothing[1]["table"]).collect() == []
