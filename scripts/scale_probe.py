"""Reproduce the README's scaling measurements (development tool, not a query).

Usage: python scripts/scale_probe.py [sf_dir] [copies]

1. Report plans: the events of ``orders`` repeated ``copies`` times (distinct
   ids), trend report with strategy join_first vs preaggregate vs auto.
2. Range join: one long street derived from ``part`` (segment k covers
   10k..10k+9) and ``orders`` (numbers spread over 0..200000); bucketed join
   vs a plain equi-join with the range as residual.
Times are wall clock of the second of two runs (code generation warm).
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from curbline.operators import match  # noqa: E402
from curbline.operators.match import match_unbucketed  # noqa: E402
from curbline.plans import reports  # noqa: E402
from curbline.session import local_session  # noqa: E402
from curbline.sources import fixtures  # noqa: E402


def timed(make) -> float:
    make()
    t0 = time.perf_counter()
    make()
    return round(time.perf_counter() - t0, 2)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    orders = fixtures.table(spark, sf_dir, "orders")
    part = fixtures.table(spark, sf_dir, "part")

    many = orders.select("o_orderkey", "o_custkey", "o_orderdate",
                         F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("i")).select(
        (F.col("o_orderkey") * copies + F.col("i")).alias("o_orderkey"), "o_custkey", "o_orderdate")
    v = fixtures.violations_from_orders(many)
    s = fixtures.segments_from_part(part)
    for strategy in ("auto", "preaggregate", "join_first"):
        t = timed(lambda: reports.trend_report(v, s, fixtures.FIXTURE_YEARS, strategy=strategy)
                  .write.format("noop").mode("overwrite").save())
        print(f"report x{copies} events, {strategy}: {t} s", flush=True)

    sides = part.select(
        F.col("p_partkey").alias("seg_ord"), F.col("p_partkey").alias("physical_id"),
        F.lit(1).alias("boro"), F.lit("LONG ST").alias("street"), F.lit("full").alias("name_role"),
        F.explode(F.array(F.lit(0), F.lit(1))).alias("parity")).select(
        "*", F.when(F.col("parity") == 0, "R").otherwise("L").alias("side"),
        (F.col("seg_ord") * 10).cast("int").alias("s_lo"),
        (F.col("seg_ord") * 10 + 9).cast("int").alias("s_hi"),
        *[F.lit(None).cast("int").alias(c) for c in ("lo1", "hi1", "lo2", "hi2")])
    events = orders.select(
        F.col("o_orderkey").alias("vid"), F.lit(1).alias("boro"), F.lit("LONG ST").alias("street"),
        ((F.col("o_orderkey") * 7919) % 200000).cast("int").alias("n1"),
        F.lit(None).cast("int").alias("n2")).withColumn("parity", F.col("n1") % 2)
    t = timed(lambda: match(events, sides, "all").count())
    print(f"long street, bucketed join: {t} s", flush=True)
    t = timed(lambda: match_unbucketed(events, sides).count())
    print(f"long street, plain equi-join + range residual: {t} s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
