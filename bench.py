"""Benchmark: headline queries on the driver's tables.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Every query runs to completion into Spark's no-op sink (all rows are
produced, none is shipped to the driver), after one warm-up run of the
flagship query; the value is the sum of the per-query wall clocks of each
query's first run. Each query then runs once more: ``queries_warm`` /
``warm_total`` are those second runs (code generation and JIT warm).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from curbline.plans import registry, reports  # noqa: E402
from curbline.session import local_session, scratch_path  # noqa: E402
from curbline.sources import csv as csv_io  # noqa: E402
from curbline.sources import fixtures  # noqa: E402

HEADLINE = [
    "segment_trend_report",      # Q1, the flagship
    "segment_trend_report_r3",   # Q2
    "trend_clean_segments",      # Q3
    "trend_matched_segments",    # Q4
    "count_id_year",             # Q5 (first match, strict)
    "match_first",               # per-event first match
    "match_all",                 # per id and year, all matches
    "union_branches",            # the bag union of the eight branches, one join
    "match_outer_or",            # right-outer form
    "pivot_by_id",               # yearly counts over the right-outer form
]


def csv_report(spark, folder: str) -> None:
    """The whole job as its users time it: event and segment CSV in, report CSV out."""
    events = csv_io.read_violations_csv(spark, f"{folder}/events", multi_line=False)
    segments = csv_io.read_segments_csv(spark, f"{folder}/segments", multi_line=False)
    csv_io.write_report_csv(reports.trend_report(events, segments, fixtures.FIXTURE_YEARS), f"{folder}/report", mode="overwrite")


def run(df) -> int:
    # materialise every row of the result without shipping it to the driver
    df.write.format("noop").mode("overwrite").save()
    return 0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, app="curbline-bench")
    spark.sparkContext.setLogLevel("ERROR")
    # the tables are files of one row group each: deal them out over the cores
    spark.conf.set("curbline.source.splits", cpus)
    qs = registry.QUERIES
    # warm-up: JVM, code generation caches, file listing
    run(qs["segment_trend_report"](spark, sf_dir))
    times: dict[str, float | None] = {}
    warm: dict[str, float | None] = {}
    errors = {}
    for name in HEADLINE:
        try:
            t0 = time.perf_counter()
            run(qs[name](spark, sf_dir))
            times[name] = round(time.perf_counter() - t0, 3)
            # a second run of the same query: code generation and JIT are warm
            t0 = time.perf_counter()
            run(qs[name](spark, sf_dir))
            warm[name] = round(time.perf_counter() - t0, 3)
        except Exception as exc:  # noqa: BLE001 - report, keep measuring the rest
            times.setdefault(name, None)
            warm[name] = None
            errors[name] = str(exc)[:300]
    # CSV in, report out; writing the input is not part of the time
    folder = scratch_path(spark, "bench-csv")
    csv_io.write_violations_csv(fixtures.violations(spark, sf_dir).repartition(int(cpus)), f"{folder}/events")
    csv_io.write_segments_csv(fixtures.segments(spark, sf_dir), f"{folder}/segments")
    for kept in (times, warm):
        t0 = time.perf_counter()
        csv_report(spark, folder)
        kept["csv_to_csv_report"] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_total_wall",
        "value": round(sum(t for t in times.values() if t is not None), 3),
        "unit": "sec",
        "queries": times,
        "queries_warm": warm,
        "warm_total": round(sum(t for t in warm.values() if t is not None), 3),
        "sf": float(m.group(1)) if m else None,
        "cpus": int(cpus),
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
