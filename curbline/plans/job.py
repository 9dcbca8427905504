"""Command-line job: the trend report from CSV (or staged Parquet) to CSV.

    spark-submit --py-files curbline.zip curbline/plans/job.py OUTPUT \
        --violations DIR --segments FILE
        [--report final|r3|clean|matched|counts] [--years 2015-2019]
        [--staged] [--by-position] [--single-line] [--checkpoint]
        [--strategy auto|join_first|preaggregate] [--broadcast auto|yes|no] [--salt N|auto]
        [--input-bytes N --cores N] [--mode errorifexists|overwrite]

(or ``python -m curbline.plans.job ...`` against a configured master).

``--report`` picks the version of the original job: ``final`` (every id, 7
digits), ``r3`` (3 digits), ``clean`` (cleaned ids only), ``matched`` (matched
ids only, whole-number slope) or ``counts`` (counts per id and year, first
match; all years unless ``--years`` is given). ``--input-bytes`` and
``--cores`` size the session's settings (``curbline.session.scale_settings``);
without them only those that hold at any size are set. ``--staged`` reads events from the year-partitioned Parquet staging
table (``curbline.sources.staging``) instead of CSV, with year pruning.
``--single-line`` reads CSV without multi-line fields, so each file is split
over many tasks (with multi-line fields a file is one task).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from curbline.plans import reports
from curbline.session import apply_settings, scale_settings
from curbline.sources import csv as csv_io
from curbline.sources import staging


def parse_years(text: str) -> tuple[int, ...]:
    lo, _, hi = text.partition("-")
    lo_i, hi_i = int(lo), int(hi or lo)
    if hi_i < lo_i:
        raise argparse.ArgumentTypeError("years must be LOW-HIGH")
    return tuple(range(lo_i, hi_i + 1))


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="curbline.plans.job", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("output", help="output path of the report (CSV, no header)")
    p.add_argument("--violations", required=True, help="event CSV directory or staged Parquet path")
    p.add_argument("--segments", required=True, help="segment CSV file or directory")
    p.add_argument("--report", default="final",
                   choices=["final", "r3", "clean", "matched", "counts"])
    p.add_argument("--years", type=parse_years,
                   help="LOW-HIGH (trend reports: 2015-2019; counts: no limit)")
    p.add_argument("--strategy", default="auto", choices=["auto", "join_first", "preaggregate"])
    p.add_argument("--broadcast", default="auto", choices=["auto", "yes", "no"],
                   help="'yes' fails if the segments' size bound is over the limit")
    p.add_argument("--salt", type=lambda x: x if x == "auto" else int(x), default=1,
                   help="deal every event key over N tasks when segments are not broadcast")
    p.add_argument("--input-bytes", type=int, help="size of the events, for the session settings")
    p.add_argument("--cores", type=int, help="cores of the cluster, for the session settings")
    p.add_argument("--staged", action="store_true", help="events are staged Parquet")
    p.add_argument("--by-position", action="store_true",
                   help="pick event CSV fields by position, not header name")
    p.add_argument("--single-line", action="store_true",
                   help="no field spans lines: split each CSV file over many tasks")
    p.add_argument("--mode", default="errorifexists", choices=["errorifexists", "overwrite"])
    p.add_argument("--checkpoint", action="store_true",
                   help="checkpoint the counts after the event scan (spark.checkpoint.dir)")
    return p


def report(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    years = args.years or (None if args.report == "counts" else reports.REFERENCE_YEARS)
    if args.staged:
        violations = staging.read_staged_violations(spark, args.violations, years)
    else:
        violations = csv_io.read_violations_csv(spark, args.violations,
                                                multi_line=not args.single_line,
                                                by_position=args.by_position)
    segments = csv_io.read_segments_csv(spark, args.segments, multi_line=not args.single_line)
    kw = {"checkpoint": args.checkpoint, "salt": args.salt,
          "broadcast": {"auto": None, "yes": True, "no": False}[args.broadcast]}
    if args.report == "counts":
        return reports.count_id_year(violations, segments, years, **kw).orderBy("physical_id", "year")
    kw["strategy"] = args.strategy
    if args.report == "final":
        return reports.trend_report(violations, segments, years, **kw)
    if args.report == "r3":
        return reports.trend_report_r3(violations, segments, years, **kw)
    if args.report == "clean":
        return reports.trend_clean_segments(violations, segments, years, **kw)
    return reports.trend_matched_segments(violations, segments, years, **kw)


def settings(args: argparse.Namespace) -> dict[str, str]:
    """Session settings of a run: all, or without sizes those that do not depend on them."""
    if args.input_bytes and args.cores:
        return scale_settings(args.input_bytes, args.cores)
    sized = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    return {k: v for k, v in scale_settings(0, 1).items() if k not in sized}


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    spark = SparkSession.builder.appName("curbline-trend-report").getOrCreate()
    apply_settings(spark, settings(args))
    out = report(spark, args)
    csv_io.write_report_csv(out, args.output, mode=args.mode)
    return 0


if __name__ == "__main__":
    sys.exit(main())
