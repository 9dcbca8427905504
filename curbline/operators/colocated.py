"""The match join between stored tables, without an exchange (J13/J14 where the sides are too big to broadcast).

``match`` shuffles the events for every join that cannot broadcast. Where the
same events are matched again and again (other reports, other years, corrected
segments), that shuffle can be paid once: events and sides are stored as
tables bucketed and sorted by all keys of the bucketed range join
(``match.JOIN_KEYS``). A later join reads bucket i of both in one task: no
Exchange stands above either scan.

* The house-number bucket is one of the keys, so a street with a third of the
  segments lies in many table buckets; ``salt`` deals a single hot address over
  several (a task's work cannot be split later: a table bucket is one task).
* Both tables carry the plan (widths, levels, salt, number of table buckets) as
  a table property; tables of different plans are refused, since
  their rows would miss each other.
* Events are stored at the levels that the sides occupy. Sides stored later
  (``store_sides`` with the events' plan) that need another level are refused:
  their matches would be lost.
* ``append_events`` adds a batch of events with the stored plan.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.operators.match import (
    JOIN_KEYS, RANGE_KEYS, SECOND_FANOUT, SEGMENT_OUT, MatchPlan, bucketed_build, bucketed_probe, choose_salt, probe_rows,
    range_condition, ranged_rows,
)

PROPERTY = "curbline.match"
KEYS = [*JOIN_KEYS, "salt_no"]
EVENT_NO = ["batch_no", "event_no"]     # tells equal events apart
KEY_TYPES = {"parity": "int", "kind": "int", "level": "int", "bucket": "bigint",
             "level2": "int", "bucket2": "bigint", "salt_no": "int"}


@dataclass(frozen=True)
class StoredPlan:
    """How a stored table's rows were keyed."""
    widths: tuple[int, int]
    levels: int
    occupied: tuple
    fanout: int
    width2: int
    levels2: int
    salt: int
    buckets: int

    @staticmethod
    def of(plan: MatchPlan, salt: int, buckets: int) -> StoredPlan:
        return StoredPlan(plan.widths, plan.levels, plan.occupied, plan.fanout, plan.width2, plan.levels2, salt, buckets)

    def match_plan(self) -> MatchPlan:
        return MatchPlan(self.widths, self.levels, self.occupied, self.fanout, 0, 0.0, 0, 0, False, self.width2, self.levels2)


def stored_plan(spark: SparkSession, table: str) -> StoredPlan:
    """The plan that ``table`` was stored with."""
    found = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    if PROPERTY not in found:
        raise ValueError(f"{table} was not stored for co-located matching")
    raw = json.loads(found[PROPERTY])
    raw["widths"] = tuple(raw["widths"])
    raw["occupied"] = tuple(tuple(tuple(level) for level in kind) for kind in raw["occupied"])
    return StoredPlan(**raw)


def _typed(rows: DataFrame) -> DataFrame:
    """Keys in one type on both sides: a table bucket is a hash of the typed value."""
    return rows.withColumns({k: F.col(k).cast(t) for k, t in KEY_TYPES.items()})


def _save(rows: DataFrame, plan: StoredPlan, table: str, path: str | None, mode: str) -> None:
    # dealt out as the table's buckets are, so that every bucket is one sorted file per write
    writer = (_typed(rows).repartition(plan.buckets, *KEYS).write.format("parquet").mode(mode)
              .bucketBy(plan.buckets, *KEYS).sortBy(*KEYS))
    (writer.option("path", path) if path else writer).saveAsTable(table)


def _mark(spark: SparkSession, table: str, plan: StoredPlan) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{PROPERTY}' = '{json.dumps(asdict(plan))}')")


def _event_rows(facts: DataFrame, plan: StoredPlan, batch: int) -> DataFrame:
    at = F.monotonically_increasing_id()
    rows = facts.select("*", F.lit(batch).alias("batch_no"), at.alias("event_no"),
                        F.pmod(at, F.lit(plan.salt)).alias("salt_no"))
    return bucketed_probe(rows, plan.match_plan())


def store_events(facts: DataFrame, plan: MatchPlan, table: str, buckets: int | None = None,
                 salt: int | str = 1, path: str | None = None) -> StoredPlan:
    """Store events (columns of ``match``) as a new table, keyed by ``plan`` (``match.plan_match`` of the sides).

    ``buckets`` is the number of tasks of every later join (default the
    session's shuffle width); ``salt='auto'`` measures the hottest address.
    Events without a number match nothing and are kept out. An empty ``facts``
    gives an empty table. ``path`` stores the files there instead of the warehouse.
    """
    spark = facts.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if salt == "auto":
        salt = choose_salt(facts, buckets)
    stored = StoredPlan.of(plan, int(salt), buckets)
    _save(_event_rows(facts.where(F.col("n1").isNotNull()), stored, 0), stored, table, path, "errorifexists")
    _mark(spark, table, stored)
    return stored


def append_events(facts: DataFrame, table: str) -> int:
    """Add a batch of events to a table of ``store_events``; its number is returned."""
    spark = facts.sparkSession
    stored = stored_plan(spark, table)
    batch = 1 + (spark.table(table).agg(F.max("batch_no")).first()[0] or 0)
    rows = _event_rows(facts.where(F.col("n1").isNotNull()), stored, batch)
    _save(rows.select(*spark.table(table).columns), stored, table, None, "append")
    return batch


def _too_wide(probe: DataFrame, plan: MatchPlan) -> bool:
    """Whether some range would cover over ``fanout`` buckets even at the plan's highest level."""
    top = plan.fanout ** (plan.levels - 1)
    over = [(F.col("kind") == kind) & (F.floor(F.col("hi") / (base * top)) - F.floor(F.col("lo") / (base * top)) >= plan.fanout)
            for kind, base in enumerate(plan.widths)]
    if plan.width2:
        top2 = plan.width2 * SECOND_FANOUT ** (plan.levels2 - 1)
        over.append((F.col("kind") == 1) & (F.floor(F.col("hi2") / top2) - F.floor(F.col("lo2") / top2) >= SECOND_FANOUT))
    return bool(probe.agg(*[F.coalesce(F.max(c), F.lit(False)).alias(f"c{i}") for i, c in enumerate(over)],
                          F.lit(False).alias("none")).select(F.greatest("none", *[f"c{i}" for i in range(len(over))])).first()[0])


def store_sides(sides: DataFrame, stored: StoredPlan, table: str, payload: Sequence[str] = SEGMENT_OUT,
                path: str | None = None, ranges: bool = False) -> None:
    """Store segment sides as a new table keyed by the events' plan.

    A side row is there once per covered house-number bucket (at most fanout + 1
    of its level) and salt. Rows that need a level at which no event is
    stored are an error, found before anything is written. ``ranges`` stores every
    distinct range once, without payload (for ``match_stored_ranges``).
    """
    spark = sides.sparkSession
    probe = ranged_rows(sides, []).distinct() if ranges else probe_rows(sides, payload)
    plan = stored.match_plan()
    if _too_wide(probe, plan):              # before rows are repeated per covered bucket
        raise ValueError("a range needs a level at which no event is stored; store the events again with a plan of these sides")
    build = bucketed_build(probe, plan)
    levels = {(r.kind, r.level, r.level2) for r in build.select("kind", "level", "level2").distinct().collect()}
    missing = levels - {(kind, *level) for kind in (0, 1) for level in stored.occupied[kind]}
    if missing:
        raise ValueError(f"no event is stored at the levels (kind, level, second level) {sorted(missing)}; "
                         "store the events again with a plan of these sides")
    build = build.withColumn("salt_no", F.explode(F.sequence(F.lit(0), F.lit(stored.salt - 1))))
    _save(build, stored, table, path, "errorifexists")
    _mark(spark, table, stored)


def match_stored(spark: SparkSession, events: str, sides: str, policy: str = "all") -> DataFrame:
    """``match`` between two stored tables: the event columns plus the stored payload.

    Policy 'all' has no Exchange at all. Policy 'first' keeps the smallest
    ``seg_ord`` per event (also of equal events); only matched pairs are
    exchanged, after the join. The sides' payload must hold ``seg_ord`` and
    ``physical_id`` for it.
    """
    if policy not in ("all", "first"):
        raise ValueError(f"unknown policy {policy!r}")
    joined, facts, payload = _stored_pairs(spark, events, sides)
    if policy == "all":
        return joined.select(*facts, *payload)
    return joined.groupBy(*EVENT_NO, *facts).agg(
        F.min("seg_ord").alias("seg_ord"), F.min_by("physical_id", "seg_ord").alias("physical_id")).drop(*EVENT_NO)


def match_stored_ranges(spark: SparkSession, events: str, ranges: str) -> DataFrame:
    """``match.match_ranges`` between stored events and stored distinct ranges (``store_sides`` with ``ranges``), without an Exchange."""
    joined, facts, _ = _stored_pairs(spark, events, ranges)
    return joined.select(*RANGE_KEYS, *[c for c in facts if c not in RANGE_KEYS])


def _stored_pairs(spark: SparkSession, events: str, sides: str) -> tuple[DataFrame, list[str], list[str]]:
    """The joined tables, the event columns and the stored payload."""
    if stored_plan(spark, events) != stored_plan(spark, sides):
        raise ValueError(f"{events} and {sides} were stored with different plans")
    e, s = spark.table(events), spark.table(sides)
    for key in KEYS:
        if e.schema[key].dataType != s.schema[key].dataType:
            raise ValueError(f"key {key} has different types in {events} and {sides}")
    added = ("kind", "level", "bucket", "level2", "bucket2", "salt_no", *EVENT_NO)
    facts = [c for c in e.columns if c not in added]
    payload = [c for c in s.columns if c not in KEYS and c not in ("lo", "hi", "lo2", "hi2")]
    return e.join(s.hint("merge"), KEYS).where(range_condition()), facts, payload
