"""Property: the bucketed join equals brute force for any ranges and bucketing."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from curbline.operators import match

SIDE_SCHEMA = ("seg_ord long, physical_id long, boro int, street string, parity int, "
               "side string, name_role string, s_lo int, s_hi int, lo1 int, hi1 int, "
               "lo2 int, hi2 int")

num = st.integers(min_value=0, max_value=5000)
opt = st.one_of(st.none(), num)


@st.composite
def side_rows(draw):
    rows = []
    for i in range(draw(st.integers(min_value=1, max_value=25))):
        par = draw(st.integers(0, 1))
        rows.append((i, i // 2, 1, draw(st.sampled_from(["A", "B"])), par,
                     "R" if par == 0 else "L", "full",
                     draw(opt), draw(opt), draw(opt), draw(opt), draw(opt), draw(opt)))
    return rows


@st.composite
def fact_rows(draw):
    rows = []
    for i in range(draw(st.integers(min_value=1, max_value=40))):
        n1 = draw(num)
        n2 = draw(opt)
        rows.append((i, 1, draw(st.sampled_from(["A", "B"])), n1, n2,
                     (n2 if n2 is not None else n1) % 2))
    return rows


def brute(facts, sides):
    out = []
    for vid, boro, street, n1, n2, par in facts:
        for s in sides:
            (so, _, sb, sst, spar, _, _, s_lo, s_hi, lo1, hi1, lo2, hi2) = s
            if (sb, sst, spar) != (boro, street, par):
                continue
            if n2 is None:
                ok = s_lo is not None and s_hi is not None and s_lo <= n1 <= s_hi
            else:
                ok = None not in (lo1, hi1, lo2, hi2) and lo1 <= n1 <= hi1 and lo2 <= n2 <= hi2
            if ok:
                out.append((vid, so))
    return sorted(out)


@settings(max_examples=16, deadline=None, derandomize=True,
          suppress_health_check=list(HealthCheck))
@given(sides=side_rows(), facts=fact_rows(),
       width=st.one_of(st.none(), st.integers(1, 300)), fanout=st.integers(2, 20),
       broadcast=st.booleans(), salt=st.integers(1, 4), second=st.sampled_from([None, True, True, False]))
def test_bucketed_join_is_exact(spark, sides, facts, width, fanout, broadcast, salt, second):
    s = spark.createDataFrame(sides, SIDE_SCHEMA)
    f = spark.createDataFrame(facts, "vid long, boro int, street string, n1 int, n2 int, parity int")
    got = match(f, s, "all", broadcast=broadcast, bucket_width=width, fanout=fanout, salt=salt, second=second)
    pairs = sorted((r["vid"], r["seg_ord"]) for r in got.select("vid", "seg_ord").collect())
    assert pairs == brute(facts, sides)
    first = match(f, s, "first", broadcast=broadcast, bucket_width=width, fanout=fanout,
                  salt=salt, second=second)
    want_first = {}
    for vid, so in brute(facts, sides):
        want_first[vid] = min(so, want_first.get(vid, so))
    assert {r["vid"]: r["seg_ord"] for r in first.collect()} == want_first
