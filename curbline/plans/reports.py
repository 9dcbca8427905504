"""Whole queries: the trend report and its variants (Q1-Q5).

The trend report (Q1) has two plans, chosen from the measured segment sides
(see ``yearly_counts``):

    join first:  events --clean/prune (pushed into the scan)--> broadcast
                 hash join with the bucketed sides (events do not move)
                 --> union with a NULL-year row per id --> count per id and
                 year (partial + final) --> slope column --> sort by id
    count first: events --clean/prune--> count per address and year
                 (partial + final) --> bucketed join (broadcast or sort-merge)
                 --> union with zero rows per id --> sum per id --> slope
                 column --> sort by id

A hot address, street or id collapses inside every map task in both plans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.functions import ols_slope, rounded
from curbline.operators import (
    ADDRESS_KEYS, clean_facts, clean_segments, count_long, match, matchable,
    pivot_years, segment_sides, totals_with_all_ids,
)
from curbline.operators.match import MatchPlan, match_ranges, match_totals, plan_match, probe_rows, range_counts
from curbline.schemas import year_columns
from curbline.session import shared_dir

REFERENCE_YEARS = (2015, 2016, 2017, 2018, 2019)
# Join events in place only while an event meets few side rows: a bucket's rows
# bound what one probe compares and matches, so rows piled up or copied on one
# house number show, whatever else is on the street. Otherwise counting per
# address first bounds the join by the distinct addresses.
JOIN_FIRST_MAX_MEAN_LOAD = 8.0
JOIN_FIRST_MAX_WORST_LOAD = 64


def join_first(plan: MatchPlan, strategy: str) -> bool:
    """'join_first', 'preaggregate' or 'auto': broadcast, and no full buckets."""
    if strategy == "join_first":
        return True
    if strategy == "preaggregate" or not plan.broadcast:
        return False
    return plan.mean_load <= JOIN_FIRST_MAX_MEAN_LOAD and plan.worst_load <= JOIN_FIRST_MAX_WORST_LOAD


def yearly_counts(
    violations: DataFrame,
    segments: DataFrame,
    years: Sequence[int] = REFERENCE_YEARS,
    aliases: str = "final",
    ids: str | None = "raw",
    broadcast: bool | None = None,
    salt: int | str = 1,
    strategy: str = "auto",
    checkpoint: bool = False,
    plan: MatchPlan | None = None,
) -> DataFrame:
    """physical_id, y<year>... : matches per segment id and year (policy 'all').

    ``ids`` chooses which ids appear without matches: 'raw' every id of the
    segment table, 'clean' ids surviving cleaning, None only matched ids.

    Two plans, chosen from the measured segment sides (``strategy='auto'``):

    * join first -- the sides are broadcast and their buckets hold few rows
      (see ``join_first``; so it is on real centerlines): events
      probe the broadcast sides where they are and only then are counted per
      (id, year). The only shuffle is that partial aggregate, whose key space
      is segments x years, far smaller than the distinct addresses.
    * count first -- otherwise: events are first counted per address and year
      (partial + final aggregate), so the join handles one row per address
      instead of one per event: it is a shuffled sort-merge join when the
      sides are too big to broadcast, and when ranges pile up the join meets
      every distinct range of a street once (``match_totals``).

    ``plan`` reuses an earlier measurement of the same segments
    (``measure_segments``) instead of reading them for it once more.

    ``checkpoint`` writes the aggregate that ends the event scan (counts per
    id and year, or per address and year) to the shared checkpoint folder
    and cuts the lineage there: executors lost afterwards cost a re-read of
    that small table, not a rescan of the events. It runs that part eagerly.
    """
    ycols = year_columns(years)
    facts = matchable(clean_facts(violations, years, aliases))
    seg = clean_segments(segments)
    sides = segment_sides(seg)
    payload = ["physical_id"]
    plan = plan or plan_match(probe_rows(sides, payload), broadcast)
    id_rows = {"raw": segments, "clean": seg, None: None}[ids]
    id_rows = None if id_rows is None else id_rows.select("physical_id")
    if join_first(plan, strategy):
        events = facts.select(*ADDRESS_KEYS, "year")
        matched = match(events, sides, "all", plan=plan, payload=payload).select(
            "physical_id", "year")
        if id_rows is not None:
            matched = matched.unionByName(
                id_rows.select("physical_id", F.lit(None).cast("int").alias("year")))
        return _cut(pivot_years(matched, ["physical_id"], years), checkpoint)
    addresses = _cut(pivot_years(facts, ADDRESS_KEYS, years), checkpoint)
    matched = match_totals(addresses, sides, ycols, payload, salt=salt, plan=plan)
    return totals_with_all_ids(matched, id_rows, ycols)


def measure_segments(segments: DataFrame, broadcast: bool | None = None) -> MatchPlan:
    """The measurement that ``trend_report`` takes of its segments, for reuse."""
    return plan_match(probe_rows(segment_sides(clean_segments(segments)), ["physical_id"]), broadcast)


def _cut(df: DataFrame, checkpoint: bool) -> DataFrame:
    """Reliable checkpoint in the folder named by the session (or unchanged)."""
    if not checkpoint:
        return df
    shared_dir(df.sparkSession)            # ensures the checkpoint folder is set
    return df.checkpoint(eager=True)


def counts_per_id_year(facts: DataFrame, sides: DataFrame,
                       broadcast: bool | None = None, salt: int | str = 1,
                       strategy: str = "auto") -> DataFrame:
    """physical_id, year, cnt over matched (event, segment row) pairs.

    Same choice as ``yearly_counts``: join events in place when the sides are
    broadcast and shallow, else count per address and year before the join.
    """
    payload = ["physical_id"]
    plan = plan_match(probe_rows(sides, payload), broadcast)
    if join_first(plan, strategy):
        m = match(facts.select(*ADDRESS_KEYS, "year"), sides, "all", plan=plan, payload=payload)
        return m.groupBy("physical_id", "year").agg(F.count(F.lit(1)).alias("cnt"))
    addresses = count_long(facts, ADDRESS_KEYS + ["year"])
    return range_counts(match_ranges(addresses, sides, plan=plan, salt=salt), sides, "physical_id", ["year"])


def with_trend(counts: DataFrame, years: Sequence[int], digits: int) -> DataFrame:
    """Adds ols_coeff (rounded slope over the year columns), sorted by id."""
    ycols = year_columns(years)
    return counts.select(
        "physical_id", *ycols,
        rounded(ols_slope(ycols, years), digits).alias("ols_coeff"),
    ).orderBy("physical_id")


def trend_report(violations: DataFrame, segments: DataFrame,
                 years: Sequence[int] = REFERENCE_YEARS, digits: int = 7,
                 aliases: str = "final", ids: str | None = "raw",
                 broadcast: bool | None = None, salt: int | str = 1,
                 strategy: str = "auto", checkpoint: bool = False,
                 plan: MatchPlan | None = None) -> DataFrame:
    """Q1: every segment id, its yearly match counts and their trend."""
    counts = yearly_counts(violations, segments, years, aliases, ids, broadcast, salt,
                           strategy, checkpoint, plan)
    return with_trend(counts, years, digits)


def trend_report_r3(violations: DataFrame, segments: DataFrame,
                    years: Sequence[int] = REFERENCE_YEARS, **kw) -> DataFrame:
    """Q2: as Q1, 3 digits, alias table without 'ST'."""
    return trend_report(violations, segments, years, digits=3, aliases="no_st", **kw)


def trend_clean_segments(violations: DataFrame, segments: DataFrame,
                         years: Sequence[int] = REFERENCE_YEARS, **kw) -> DataFrame:
    """Q3: ids of cleaned segments only (rows with NULLs are not reported)."""
    return trend_report(violations, segments, years, digits=3, aliases="no_st",
                        ids="clean", **kw)


def trend_matched_segments(violations: DataFrame, segments: DataFrame,
                           years: Sequence[int] = REFERENCE_YEARS, **kw) -> DataFrame:
    """Q4: matched ids only, slope rounded to a whole number."""
    return trend_report(violations, segments, years, digits=0, aliases="no_st",
                        ids=None, **kw)


def top_by_id(report: DataFrame, n: int = 50) -> DataFrame:
    """The first ``n`` rows in id order (the report's ``show(50)``)."""
    return report.orderBy("physical_id").limit(n)


def count_id_year(violations: DataFrame, segments: DataFrame,
                  years: Sequence[int] | None = None,
                  broadcast: bool | None = None, checkpoint: bool = False,
                  salt: int | str = 1) -> DataFrame:
    """Q5: physical_id, year, cnt -- at most one segment per event.

    The first version of the job: validated dates (no year range unless
    given), strict county codes (alias table without 'PBX', unknown values
    dropped), segments kept even with NULL fields, a simple house number
    compared only with whole (non-compound) bounds, first match in segment
    order wins. Events are counted per address and year before the join and
    the first match is chosen per address (same segments for equal
    addresses), then counts are summed per id and year.
    """
    facts = matchable(clean_facts(violations, years, aliases="no_pbx",
                                  year_mode="parsed", strict_county=True))
    facts = facts.where(F.col("year").isNotNull())
    addresses = _cut(count_long(facts, ADDRESS_KEYS + ["year"]), checkpoint)
    sides = segment_sides(clean_segments(segments, drop_nulls=False), strict=True)
    first = match(addresses, sides, "first", broadcast, salt)
    return first.groupBy("physical_id", "year").agg(F.sum("cnt").cast("bigint").alias("cnt"))
