"""Matching events to segment sides (J1-J15): a bucketed range join.

One equi-join replaces the eight OR-free branches of the reference:

    keys       boro, street, parity, kind (0 simple / 1 compound number)
    residual   lo <= n1 <= hi  and, for compound numbers, lo2 <= n2 <= hi2

Equality on (boro, street, parity) alone leaves every event probing every
side row of its street: quadratic for long streets, and a street holding a
third of all segments would dominate the job. So the range itself becomes a
key, by **multi-level bucketing** of the house number:

* Level l has bucket width ``B_kind * fanout**l``. ``B_kind`` is the power
  of two above the median range width of that kind of row (or given).
* A side row is placed at the lowest level where its range covers at most
  ``fanout`` buckets, and is repeated once per covered bucket.
* An event probes one bucket per level that side rows of its kind occupy:
  (level, n1 // width(level)). One dirty row with a huge range adds one level.

A side row that contains n1 shares exactly one (level, bucket) with the
event, so every match is found once -- no candidate cap, no missed wide
range -- and the build side grows by at most ``fanout + 1`` rows per side
row, the probe side by the (small) number of occupied levels.

A compound number has two parts. Where many side rows share a range of the first
part and differ in the second (one wide range of n1, thousands of narrow ones of
n2), buckets of n1 alone stay full; then the second part is bucketed the same way,
with a smaller fanout, and keys are (level, bucket) in both dimensions. The plan
measures the fullest bucket both ways and takes the second dimension only where it helps.

Strategy: the side table is a dimension. Two small aggregates over it
(``plan_match``) give the range widths and longest strings, then the exact
number of bucketed rows, the occupied levels and how full the buckets are.
From these comes an *upper bound* in bytes of the broadcast hash relation.
Only the payload columns a caller needs travel with it. Only when that bound
is below ``curbline.broadcast.maxBytes`` (default 256 MiB) is the side
broadcast, and the events are never shuffled for the join. Otherwise the join
is a shuffled sort-merge equi-join on all the keys above (hinted, so that no
low static estimate broadcasts it anyway); the bucket key spreads a hot street
over many tasks, AQE splits what is still skewed, and ``salt`` > 1 additionally
deals the events of every key, also of one hot address, over ``salt`` tasks.

Policy 'all' keeps every (event, matching segment row) pair. Policy 'first'
keeps the smallest ``seg_ord`` per event row. With broadcast sides that is a
lookup of each occupied level's bucket: no event moves. Without, event rows are
numbered and the pairs reduced by ``min`` (a partial aggregate). Equal event
rows are counted each. Side rows of one range are reduced to their first before
the join: the join meets the distinct ranges of a street, however many rows share them.

``match_totals`` is the form for counts: events per address meet the distinct
ranges, and the side rows take up their range's totals by an equi-join.

``match_pairs`` is the form for results that are all pairs: the events of one
address meet a side row together, ``BLOCK`` at a time, and are taken apart after
the join. The range test and the probe are then per block; and as the
pairs come out block by block, a stored result has a side row's columns in
runs and its events in repeats, which column files keep in a fraction of the space.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

EQUI_KEYS = ["boro", "street", "parity"]
JOIN_KEYS = EQUI_KEYS + ["kind", "level", "bucket", "level2", "bucket2"]
NUMBER_KEYS = EQUI_KEYS + ["n1", "n2"]      # an event's address
RANGE_KEYS = EQUI_KEYS + ["kind", "lo", "hi", "lo2", "hi2"]
SEGMENT_OUT = ["seg_ord", "physical_id", "side", "name_role"]
DEFAULT_BROADCAST_MAX_BYTES = 256 * 1024 * 1024
DEFAULT_FANOUT = 16
SECOND_FANOUT = 4                       # buckets of the second part that a row covers at its level
BLOCK = 256                             # events of an address that meet a side row together
SECOND_FROM = 64                        # rows of a compound bucket above which the second part is measured


def range_condition() -> Column:
    """Inclusive one- or two-dimensional range test on probe rows."""
    n1, n2 = F.col("n1"), F.col("n2")
    return n1.between(F.col("lo"), F.col("hi")) & (
        n2.isNull() | n2.between(F.col("lo2"), F.col("hi2")))


def probe_rows(sides: DataFrame, payload: Sequence[str] = SEGMENT_OUT) -> DataFrame:
    """Side rows split by the kind of number they can match.

    kind 0 (simple number): range s_lo..s_hi. kind 1 (compound): lo1..hi1 for
    the first part, lo2..hi2 for the second. Empty or NULL ranges are dropped.
    Only the ``payload`` columns travel with the build side.
    """
    payload = list(payload)
    simple = F.struct(F.lit(0).alias("kind"), F.col("s_lo").alias("lo"),
                      F.col("s_hi").alias("hi"), F.lit(None).cast("int").alias("lo2"),
                      F.lit(None).cast("int").alias("hi2"))
    compound = F.struct(F.lit(1).alias("kind"), F.col("lo1").alias("lo"),
                        F.col("hi1").alias("hi"), F.col("lo2").alias("lo2"),
                        F.col("hi2").alias("hi2"))
    rows = sides.select(*payload, *EQUI_KEYS,
                        F.explode(F.array(simple, compound)).alias("p")).select(
        *payload, *EQUI_KEYS, "p.*")
    ok = (F.col("lo") <= F.col("hi")) & (
        (F.col("kind") == 0) | (F.col("lo2") <= F.col("hi2")))
    return rows.where(ok)


@dataclass(frozen=True)
class MatchPlan:
    """Decisions taken from two small aggregates over the probe rows."""
    widths: tuple[int, int]                 # base bucket width per kind
    levels: int                             # number of levels a row may be placed at
    occupied: tuple[tuple[tuple[int, int], ...], ...]   # (level, second level) that rows of each kind are at
    fanout: int
    rows: int                               # bucketed rows
    mean_load: float                        # rows of the bucket that a bucketed row is in, on average
    worst_load: int                         # rows of the fullest bucket
    size_bound: int                         # bytes, upper bound of the bucketed build side
    broadcast: bool
    width2: int = 0                         # base bucket width of the second part (0: not bucketed)
    levels2: int = 1


ENTRY_OVERHEAD = 48                     # hash-map slot, pointers, length words


def broadcast_limit(spark: SparkSession) -> int:
    conf = spark.conf.get("curbline.broadcast.maxBytes", None)
    return int(conf) if conf else DEFAULT_BROADCAST_MAX_BYTES


def plan_match(probe: DataFrame, broadcast: bool | None = None,
               bucket_width: int | None = None, fanout: int = DEFAULT_FANOUT,
               second: bool | None = None) -> MatchPlan:
    """Measure the build side and choose bucketing and strategy.

    A first aggregate gives, per kind of row, the median and widest range, and
    the longest value (in bytes) of every string column. The base width is the
    smallest power of two above the median (or ``bucket_width``). A second one
    counts the bucketed rows per (kind, level) and the fullest bucket: the
    exact row count times (value row + key row + entry overhead) bounds the
    broadcast hash relation. ``broadcast=True`` asks for a broadcast and is an
    error when that bound is over the limit; ``False`` forbids one. ``second`` asks
    for buckets of the second part or forbids them; by default they are taken if
    a compound bucket has over ``SECOND_FROM`` rows and they at least halve the fullest.
    """
    if fanout < 2:
        raise ValueError("fanout must be >= 2")
    strings = [f.name for f in probe.schema.fields if isinstance(f.dataType, T.StringType)]
    w = F.col("hi").cast("bigint") - F.col("lo").cast("bigint")
    aggs = [F.max(F.octet_length(c)).alias(f"len_{c}") for c in strings]
    for k in (0, 1):
        wk = F.when(F.col("kind") == k, w)
        aggs += [F.percentile_approx(wk, 0.5).alias(f"med{k}"), F.max(wk).alias(f"max{k}")]
    w2 = F.when(F.col("kind") == 1, F.col("hi2").cast("bigint") - F.col("lo2").cast("bigint"))
    aggs += [F.percentile_approx(w2, 0.5).alias("med_second"), F.max(w2).alias("max_second")]
    st = probe.agg(*aggs).first()
    widths = []
    levels = 1
    for k in (0, 1):
        base = bucket_width or 1 << max(0, int(st[f"med{k}"] or 0)).bit_length()  # power of two > median
        widths.append(base)
        # lowest level whose bucket width lets the widest range span <= fanout
        lv = 1
        while int(st[f"max{k}"] or 0) // (base * fanout ** (lv - 1)) + 2 > fanout:
            lv += 1
        levels = max(levels, lv)
    draft = MatchPlan((widths[0], widths[1]), levels, ((), ()), fanout, 0, 0.0, 0, 0, False)
    loads = [] if second else _loads(probe, draft)
    full = max((r["worst"] for r in loads if r["kind"] == 1), default=0)
    if second or (second is None and full > SECOND_FROM):
        width2, levels2 = 1 << max(0, int(st["med_second"] or 0)).bit_length(), 1
        while int(st["max_second"] or 0) // (width2 * SECOND_FANOUT ** (levels2 - 1)) + 2 > SECOND_FANOUT:
            levels2 += 1
        finer = replace(draft, width2=width2, levels2=levels2)
        found = _loads(probe, finer)
        if second or 2 * max((r["worst"] for r in found if r["kind"] == 1), default=0) <= full:
            draft, loads = finer, found
    rows = sum(r["rows"] for r in loads)
    pad = {c: ((int(st[f"len_{c}"] or 0) + 7) // 8) * 8 for c in strings}
    value_row = 8 + 8 * (len(probe.columns) + 4) + sum(pad.values())   # + levels, buckets
    key_row = 8 + 8 * len(JOIN_KEYS) + pad.get("street", 0)
    size_bound = rows * (value_row + key_row + ENTRY_OVERHEAD)
    fits = size_bound <= broadcast_limit(probe.sparkSession)
    if broadcast and not fits:
        raise ValueError(f"broadcast asked for, but the sides may take {size_bound} bytes "
                         "(curbline.broadcast.maxBytes)")
    occupied = tuple(tuple(sorted((r["level"], r["level2"]) for r in loads if r["kind"] == k)) for k in (0, 1))
    return replace(draft, occupied=occupied, rows=rows,
                   mean_load=sum(r["squares"] for r in loads) / rows if rows else 0.0,
                   worst_load=max((r["worst"] for r in loads), default=0), size_bound=size_bound,
                   broadcast=fits if broadcast is None else broadcast)


def _loads(probe: DataFrame, plan: MatchPlan) -> list:
    """Rows, fullest bucket and sum of squares per occupied (kind, level, second level): a few rows."""
    keyed = bucketed_build(probe.select(*EQUI_KEYS, "kind", "lo", "hi", "lo2", "hi2"), plan)
    return (keyed.groupBy(*JOIN_KEYS).agg(F.count(F.lit(1)).alias("n"))
            .groupBy("kind", "level", "level2").agg(F.sum("n").alias("rows"), F.max("n").alias("worst"),
                                                    F.sum(F.col("n").cast("double") * F.col("n")).alias("squares"))
            .collect())


def _level_width(plan: MatchPlan, kind: Column, level: int) -> Column:
    f = plan.fanout ** level
    return F.when(kind == 0, F.lit(plan.widths[0] * f)).otherwise(F.lit(plan.widths[1] * f))


def bucketed_build(probe: DataFrame, plan: MatchPlan) -> DataFrame:
    """Place every probe row at its level and repeat it per covered bucket."""
    kind, lo, hi = F.col("kind"), F.col("lo"), F.col("hi")
    level = None
    for lv in range(plan.levels - 1, -1, -1):
        width = _level_width(plan, kind, lv)
        fits = (F.floor(hi / width) - F.floor(lo / width) + 1) <= plan.fanout
        level = F.lit(lv) if level is None else F.when(fits, F.lit(lv)).otherwise(level)
    width = None
    for lv in range(plan.levels):
        w = _level_width(plan, kind, lv)
        width = w if width is None else F.when(F.col("level") == lv, w).otherwise(width)
    placed = probe.withColumn("level", level).withColumn("_w", width)
    placed = placed.withColumn(
        "bucket", F.explode(F.sequence(F.floor(lo / F.col("_w")), F.floor(hi / F.col("_w"))))
    ).drop("_w")
    if not plan.width2:
        return placed.withColumn("level2", F.lit(0)).withColumn("bucket2", F.lit(0).cast("bigint"))
    lo2, hi2 = F.col("lo2"), F.col("hi2")
    level2, w2 = F.lit(plan.levels2 - 1), F.lit(_second_width(plan, plan.levels2 - 1))
    for lv in range(plan.levels2 - 2, -1, -1):
        here = _second_width(plan, lv)
        fits = (F.floor(hi2 / here) - F.floor(lo2 / here) + 1) <= SECOND_FANOUT
        level2, w2 = F.when(fits, F.lit(lv)).otherwise(level2), F.when(fits, F.lit(here)).otherwise(w2)
    compound = kind == 1
    placed = placed.withColumn("level2", F.when(compound, level2).otherwise(F.lit(0))).withColumn("_w", w2)
    covered = F.when(compound, F.sequence(F.floor(lo2 / F.col("_w")), F.floor(hi2 / F.col("_w")))).otherwise(
        F.array(F.lit(0).cast("bigint")))
    return placed.withColumn("bucket2", F.explode(covered)).drop("_w")


def _second_width(plan: MatchPlan, level: int) -> int:
    return plan.width2 * SECOND_FANOUT ** level


def _second_bucket(plan: MatchPlan, level: int) -> Column:
    """The event's bucket of its second part (0 where the part is not bucketed, or absent)."""
    if not plan.width2:
        return F.lit(0).cast("bigint")
    return F.coalesce(F.floor(F.col("n2") / _second_width(plan, level)), F.lit(0).cast("bigint"))


def bucketed_probe(facts: DataFrame, plan: MatchPlan) -> DataFrame:
    """Every event once per level occupied by its kind, with its bucket there."""
    def keys(kind: int) -> Column:
        return F.array(*[
            F.struct(F.lit(lv).alias("level"), F.floor(F.col("n1") / _level_width(plan, F.lit(kind), lv)).alias("bucket"),
                     F.lit(lv2).alias("level2"), _second_bucket(plan, lv2).alias("bucket2"))
            for lv, lv2 in plan.occupied[kind]]).cast("array<struct<level:int,bucket:bigint,level2:int,bucket2:bigint>>")

    kind = F.when(F.col("n2").isNull(), F.lit(0)).otherwise(F.lit(1))
    return facts.select("*", kind.alias("kind"), F.explode(
        F.when(F.col("n2").isNull(), keys(0)).otherwise(keys(1))).alias("_k")).select(
        *facts.columns, "kind", "_k.*")


def choose_salt(facts: DataFrame, tasks: int | None = None) -> int:
    """How many ways to deal each event key so that the hottest address is no
    larger than an even task: its share of the events times ``tasks`` (default
    the session's shuffle width), at least 1. One aggregate over the events."""
    tasks = tasks or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row = (facts.groupBy(*EQUI_KEYS, "n1", "n2").agg(F.count(F.lit(1)).alias("n"))
           .agg(F.max("n").alias("hot"), F.sum("n").alias("total")).first())
    return max(1, -(-int(row["hot"] or 0) * tasks // max(1, int(row["total"] or 0))))


def _first_by_lookup(facts: DataFrame, probe: DataFrame, plan: MatchPlan) -> DataFrame:
    """Policy 'first' with broadcast sides: one lookup per occupied level."""
    cand = F.struct("seg_ord", "physical_id", "lo", "hi", "lo2", "hi2")
    build = bucketed_build(probe, plan).groupBy(*JOIN_KEYS).agg(F.collect_list(cand).alias("_cands"))
    stream = facts.withColumn("kind", F.when(F.col("n2").isNull(), F.lit(0)).otherwise(F.lit(1)))
    names: list[str] = []
    for lv, lv2 in sorted(set(plan.occupied[0]) | set(plan.occupied[1])):
        at = stream.withColumn("bucket", F.floor(F.col("n1") / _level_width(plan, F.col("kind"), lv))).withColumn(
            "bucket2", _second_bucket(plan, lv2))
        here = F.broadcast(build.where((F.col("level") == lv) & (F.col("level2") == lv2)).drop("level", "level2"))
        found = at.join(here, on=[k for k in JOIN_KEYS if k not in ("level", "level2")], how="left")
        n1, n2 = F.col("n1"), F.col("n2")
        hits = F.transform(
            F.filter("_cands", lambda c: n1.between(c["lo"], c["hi"]) & (n2.isNull() | n2.between(c["lo2"], c["hi2"]))),
            lambda c: F.struct(c["seg_ord"].alias("seg_ord"), c["physical_id"].alias("physical_id")))
        stream = found.select(*facts.columns, "kind", *names, F.array_min(hits).alias(f"_hit{lv}_{lv2}"))
        names.append(f"_hit{lv}_{lv2}")
    if not names:                           # no side rows at all
        return facts.where(F.lit(False)).select("*", *[F.lit(None).cast(probe.schema[c].dataType).alias(c) for c in ("seg_ord", "physical_id")])
    first = F.array_min(F.array_compact(F.array(*names)))
    return (stream.select(*facts.columns, first.alias("_first")).where(F.col("_first").isNotNull())
            .select(*facts.columns, "_first.seg_ord", "_first.physical_id"))


def match(
    facts: DataFrame,
    sides: DataFrame,
    policy: str = "all",
    broadcast: bool | None = None,
    salt: int | str = 1,
    bucket_width: int | None = None,
    fanout: int = DEFAULT_FANOUT,
    second: bool | None = None,
    plan: MatchPlan | None = None,
    payload: Sequence[str] = SEGMENT_OUT,
) -> DataFrame:
    """Join events (columns boro, street, parity, n1, n2 + more) to sides.

    Returns the event columns plus the side columns in ``payload`` (default
    seg_ord, physical_id, side, name_role) for policy 'all', or plus seg_ord,
    physical_id for policy 'first'. ``plan`` reuses a measurement of a
    superset of ``sides`` with at least this payload (its bound still holds).
    ``salt`` matters only without a broadcast; 'auto' measures the events
    (``choose_salt``). Policy 'first' without a broadcast numbers the event
    rows by their place in the scan, so ``facts`` should come from a stored
    table.
    """
    if policy not in ("all", "first"):
        raise ValueError(f"unknown policy {policy!r}")
    payload = list(payload)
    if policy == "first":
        payload = ["seg_ord", "physical_id"]
    probe = probe_rows(sides, payload)
    if policy == "first":
        probe = _first_per_range(probe)
    if plan is None:
        plan = plan_match(probe, broadcast, bucket_width, fanout, second)
    if policy == "first" and plan.broadcast:
        return _first_by_lookup(facts, probe, plan)
    numbered = facts if policy == "all" else facts.withColumn("_row", F.monotonically_increasing_id())
    joined = _bucketed_join(numbered, probe, plan, salt)
    if policy == "all":
        return joined.select(*facts.columns, *payload)
    return joined.groupBy("_row", *facts.columns).agg(
        F.min("seg_ord").alias("seg_ord"),
        F.min_by("physical_id", "seg_ord").alias("physical_id"),
    ).drop("_row")


def _first_per_range(probe: DataFrame) -> DataFrame:
    """Of the side rows with one range (that every number in it meets alike) the first."""
    first = F.min(F.struct("seg_ord", "physical_id")).alias("_first")
    return probe.groupBy(*RANGE_KEYS).agg(first).select("_first.*", *RANGE_KEYS)


def ranged_rows(sides: DataFrame, payload: Sequence[str]) -> DataFrame:
    """``probe_rows`` whose RANGE_KEYS are never null (the second part is 0 where a row has none)."""
    whole = {c: F.coalesce(c, F.lit(0)) for c in ("lo2", "hi2")}
    return probe_rows(sides, payload).withColumns(whole)


def match_pairs(facts: DataFrame, sides: DataFrame, broadcast: bool | None = None, salt: int | str = 1,
                plan: MatchPlan | None = None, payload: Sequence[str] = SEGMENT_OUT, **measure) -> DataFrame:
    """The rows of ``match(..., 'all')``, block by block (``event_blocks``).

    The events are dealt out by address once, over the session's shuffle width,
    so that the pairs are made by so many tasks however few the events' files are.
    """
    events, payload = [c for c in facts.columns if c not in NUMBER_KEYS], list(payload)
    if not events:
        return match(facts, sides, "all", broadcast, salt, plan=plan, payload=payload, **measure)
    probe = probe_rows(sides, payload)
    plan = plan or plan_match(probe, broadcast, **measure)
    joined = _bucketed_join(event_blocks(facts), probe, plan, salt)
    each = joined.select(*NUMBER_KEYS, *payload, F.explode("_events").alias("_event"))
    one = {c: F.col(f"_event.{c}").alias(c) for c in events} if len(events) > 1 else {events[0]: F.col("_event").alias(events[0])}
    return each.select(*[one.get(c, F.col(c)) for c in facts.columns], *payload)


def event_blocks(facts: DataFrame, size: int = BLOCK) -> DataFrame:
    """NUMBER_KEYS and ``_events``: the other columns of up to ``size`` events of an address (a bare array of a single column).

    Every event row is in one block. An address with more events than an even
    task is dealt out over several; there are fewer such addresses than tasks.
    """
    events, tasks = [c for c in facts.columns if c not in NUMBER_KEYS], int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = facts.groupBy(*NUMBER_KEYS).agg(F.count(F.lit(1)).alias("n"))
    top = counts.select(F.xxhash64(*NUMBER_KEYS).alias("key"), "n").orderBy(F.desc("n")).limit(tasks)
    total = counts.agg(F.sum("n").alias("total"))
    hot = top.crossJoin(total).where(F.col("n") * tasks > F.col("total")).collect()
    ways = F.lit(1)
    if hot:
        # the row's place, not its values: equal events are dealt out as well
        entries = [F.lit(v) for r in hot for v in (r["key"], -(-r["n"] * tasks // r["total"]))]
        known = F.map_from_arrays(F.array(*entries[::2]), F.array(*entries[1::2]))
        ways = F.coalesce(F.try_element_at(known, F.xxhash64(*NUMBER_KEYS)), F.lit(1))
    dealt = [*NUMBER_KEYS, "_deal"]
    rows = facts.withColumn("_deal", F.pmod(F.monotonically_increasing_id(), ways)).repartition(tasks, *dealt)
    place = F.row_number().over(Window.partitionBy(*dealt).orderBy(*events)) - 1
    blocks = (rows.withColumn("_block", F.floor(place / size)).groupBy(*dealt, "_block")
              .agg(F.collect_list(F.struct(*events)).alias("_events")))
    if len(events) == 1:
        blocks = blocks.withColumn("_events", F.col(f"_events.{events[0]}"))
    return blocks.select(*NUMBER_KEYS, "_events")


def match_totals(facts: DataFrame, sides: DataFrame, cols: Sequence[str], payload: Sequence[str],
                 broadcast: bool | None = None, salt: int | str = 1, plan: MatchPlan | None = None,
                 **measure) -> DataFrame:
    """Sums of the counts ``cols`` of the matching ``facts`` (one row per address) for every side row with a match.

    Returns ``payload`` + ``cols``, once per side row and kind of number: summed
    over the rows of an id they equal the sums over ``match``'s pairs. The pairs
    are of addresses and distinct ranges, so their number is bounded by the
    house numbers and ranges of a street, not by events or segments.
    """
    hits = match_ranges(facts, sides, broadcast, salt, plan, **measure)
    totals = hits.groupBy(*RANGE_KEYS).agg(*[F.sum(c).cast("bigint").alias(c) for c in cols])
    return ranged_rows(sides, payload).join(totals, RANGE_KEYS).select(*payload, *cols)


def match_ranges(facts: DataFrame, sides: DataFrame, broadcast: bool | None = None, salt: int | str = 1,
                 plan: MatchPlan | None = None, **measure) -> DataFrame:
    """``facts`` with RANGE_KEYS, once per distinct range of the sides that contains their number."""
    ranges = ranged_rows(sides, []).distinct()
    plan = plan or plan_match(ranges, broadcast, **measure)
    joined = _bucketed_join(facts, ranges, plan, salt)
    return joined.select(*RANGE_KEYS, *[c for c in facts.columns if c not in RANGE_KEYS])


def range_counts(hits: DataFrame, sides: DataFrame, key: str, by: Sequence[str], weight: str = "cnt") -> DataFrame:
    """key, by..., weight: rows of ``match_ranges`` summed per range, taken up by the side rows, summed per ``key``."""
    totals = hits.groupBy(*RANGE_KEYS, *by).agg(F.sum(weight).alias(weight))
    rows = ranged_rows(sides, [key]).join(totals, RANGE_KEYS)
    return rows.groupBy(key, *by).agg(F.sum(weight).cast("bigint").alias(weight))


def _bucketed_join(numbered: DataFrame, probe: DataFrame, plan: MatchPlan, salt: int | str) -> DataFrame:
    """Events with all columns of the probe rows that contain their number."""
    build = bucketed_build(probe, plan)
    keys = list(JOIN_KEYS)
    if plan.broadcast:
        stream = bucketed_probe(numbered, plan)
        build = F.broadcast(build)
    else:
        if salt == "auto":
            salt = choose_salt(numbered)
        if salt > 1:
            # the row's place, not its values: equal events are dealt out as well
            numbered = numbered.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salt)).cast("int"))
            build = build.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
            keys.append("_salt")
        stream = bucketed_probe(numbered, plan)
        # the size check refused a broadcast: say so, so that a low static
        # estimate cannot broadcast it anyway; sort-merge spills and AQE
        # splits skewed partitions
        build = build.hint("merge")
    return stream.join(build, on=keys, how="inner").where(range_condition())


def match_unbucketed(facts: DataFrame, sides: DataFrame, broadcast: bool | None = None) -> DataFrame:
    """The plain form: equi-join on (boro, street, parity, kind), range residual.

    Same result as ``match(..., 'all')``; kept to measure what bucketing buys.
    The sides are broadcast only if the bucketed sides' bound (which is larger)
    allows it; ``broadcast=False`` forbids it.
    """
    probe = probe_rows(sides)
    stream = facts.withColumn("kind", F.when(F.col("n2").isNull(), 0).otherwise(1))
    build = F.broadcast(probe) if plan_match(probe, broadcast).broadcast else probe.hint("merge")
    return (stream.join(build, on=EQUI_KEYS + ["kind"], how="inner")
            .where(range_condition()).select(*facts.columns, *SEGMENT_OUT))


# --- branch view of the same join (J1-J8) ---------------------------------

BRANCHES = {
    # id: (compound?, side, name role)
    1: (False, "R", "full"), 2: (False, "R", "label"),
    3: (False, "L", "full"), 4: (False, "L", "label"),
    5: (True, "R", "full"), 6: (True, "R", "label"),
    7: (True, "L", "full"), 8: (True, "L", "label"),
}


def branch_id() -> Column:
    """Which of the reference's eight branches a match row belongs to (1..8)."""
    return (F.lit(1)
            + F.when(F.col("n2").isNotNull(), 4).otherwise(0)
            + F.when(F.col("side") == "L", 2).otherwise(0)
            + F.when(F.col("name_role") == "label", 1).otherwise(0))


def branch(matched: DataFrame, branch_no: int) -> DataFrame:
    """Rows of one branch, taken from the single join's output."""
    compound, side, role = BRANCHES[branch_no]
    kind = F.col("n2").isNotNull() if compound else F.col("n2").isNull()
    return matched.where(kind & (F.col("side") == side) & (F.col("name_role") == role))


def union_branches(facts: DataFrame, sides: DataFrame, broadcast: bool | None = None,
                   salt: int | str = 1) -> DataFrame:
    """The bag union of the eight branches (columns of ``facts`` + SEGMENT_OUT + branch).

    A side row and the kind of number it is compared with belong to exactly one
    branch, so the union is the single join's rows with their branch number:
    one scan of the events and one of the segments.
    """
    return match_pairs(facts, sides, broadcast, salt).withColumn("branch", branch_id())


def union_all(dfs: list[DataFrame]) -> DataFrame:
    """N-ary bag union by column name."""
    return functools.reduce(DataFrame.unionByName, dfs)
