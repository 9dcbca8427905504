"""All pairs, made block by block: same rows as ``match``, in long runs of one side row."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from curbline.operators import match, match_inner, match_outer, match_pairs, union_branches
from curbline.operators.match import event_blocks

SIDES = ("seg_ord long, physical_id long, boro int, street string, parity int, side string, name_role string, "
         "s_lo int, s_hi int, lo1 int, hi1 int, lo2 int, hi2 int")
EVENTS = "vid long, year int, boro int, street string, parity int, n1 int, n2 int"


@pytest.fixture(scope="module")
def sides(spark):
    rows = [(i, i // 2, 1, "A", 0, "R", "label" if i % 3 else "full", 2, 10 + 10 * (i % 2), 2, 9, 1, 5) for i in range(40)]
    return spark.createDataFrame([*rows, (99, 49, 1, "A", 0, "R", "full", 100, 300, 5, 5, 9, 9)], SIDES)


@pytest.fixture(scope="module")
def facts(spark):
    # a hot address, a compound one, equal rows, null ids and years, and events that match nothing
    rows = [(i, 1995 + i % 3, 1, "A", 0, 4, None) for i in range(700)]
    rows += [(1000 + i, 1995, 1, "A", 0, 4, 4) for i in range(5)] + [(7, 1996, 1, "A", 0, 14, None)] * 4
    rows += [(None, None, 1, "A", 0, 14, None)] * 3 + [(8, None, 1, "B", 0, 4, None), (9, 1997, 1, "A", 0, None, None)]
    return spark.createDataFrame(rows, EVENTS).repartition(5)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("options", [{}, {"broadcast": False}, {"broadcast": False, "salt": 3}, {"bucket_width": 1, "fanout": 2}])
def test_pairs_are_those_of_match(facts, sides, options):
    for cols in (["vid", "year"], ["vid"], ["year"], []):
        few = facts.select(*cols, "boro", "street", "n1", "n2", "parity")
        got, want = match_pairs(few, sides, **options), match(few, sides, "all", **options)
        assert got.columns == want.columns and bag(got) == bag(want), cols


def test_every_event_is_in_one_block(facts):
    for cols in (["vid", "year"], ["vid"]):
        few = facts.select(*cols, "boro", "street", "n1", "n2", "parity")
        blocks = event_blocks(few, 16)
        assert blocks.agg(F.max(F.size("_events"))).first()[0] == 16
        each = blocks.select("*", F.explode("_events").alias("e"))
        one = [F.col(f"e.{c}") for c in cols] if len(cols) > 1 else [F.col("e")]
        assert bag(each.select(*one, "boro", "street", "n1", "n2", "parity")) == bag(few)


def test_hot_address_is_dealt_out(spark, facts):
    # 700 of 714 events are of one address: its rows are in several tasks
    tasks = (event_blocks(facts, 16).where("n1 = 4 AND n2 IS NULL AND street = 'A'")
             .select(F.spark_partition_id().alias("p")).distinct().count())
    assert tasks > 1


def test_no_events(facts, sides):
    assert match_pairs(facts.limit(0), sides).count() == 0
    assert match_pairs(facts, sides.limit(0)).count() == 0


def test_a_side_row_comes_in_runs(facts, sides):
    """Its columns are kept as runs by column files; event by event they changed in every row."""
    for made in (union_branches(facts, sides), match_inner(facts, sides)):
        got = [r.seg_ord for r in made.collect()]
        assert len(got) > 28_000
        assert sum(a != b for a, b in zip(got, got[1:])) < len(got) / 10


def test_outer_keeps_rows_that_only_a_pair_would_show(spark, facts, sides):
    segments = sides.select("seg_ord", "physical_id").distinct()
    pairs = match(facts, sides, "all")
    outer = match_outer(facts, sides, segments)
    alone = outer.where("vid IS NULL AND year IS NULL").groupBy("seg_ord").count().collect()
    nulls = Counter(r.seg_ord for r in pairs.where("vid IS NULL").collect())
    assert {r.seg_ord: r["count"] for r in alone} == {**nulls, 99: 1}
    four = match_outer(facts, sides, segments, per="branch").where("seg_ord IN (0, 99) AND year IS NULL").groupBy("seg_ord").count()
    # row 0: hit by simple and compound numbers on the right side only
    assert dict(map(tuple, four.collect())) == {0: 2, 99: 4}
