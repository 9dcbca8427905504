"""Segment sides: the build side of the match join.

A segment row has a right side (even numbers, R bounds) and a left side (odd
numbers, L bounds), and one or two street names. Exploding to one row per
(side, name) turns the reference's eight OR-free join branches into a single
equi-join on (boro, street, parity) with a range residual.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.operators.clean import with_street_names

SIDE_COLUMNS = ["seg_ord", "physical_id", "boro", "street", "parity", "side",
                "name_role", "s_lo", "s_hi", "lo1", "hi1", "lo2", "hi2"]


def _side(parity: int, tag: str, prefix: str, strict: bool) -> F.Column:
    low, high = f"{prefix}_low_hn", f"{prefix}_high_hn"
    simple_part = "0" if strict else "1"
    return F.struct(
        F.lit(parity).alias("parity"),
        F.lit(tag).alias("side"),
        F.col(f"{low}_{simple_part}").alias("s_lo"),
        F.col(f"{high}_{simple_part}").alias("s_hi"),
        F.col(f"{low}_1").alias("lo1"),
        F.col(f"{high}_1").alias("hi1"),
        F.col(f"{low}_2").alias("lo2"),
        F.col(f"{high}_2").alias("hi2"),
    )


def segment_sides(seg_clean: DataFrame, strict: bool = False) -> DataFrame:
    """One row per (segment row, side, distinct street name); schema SIDE_COLUMNS.

    ``s_lo``/``s_hi`` bound simple (one-part) numbers: the first part of the
    bound, or with ``strict`` (J15) the whole bound, so a simple number never
    matches a compound bound. ``lo1..hi2`` bound compound numbers.
    Rows that cannot match anything (no usable bound) are dropped here, which
    keeps the broadcast small.
    """
    by_name = with_street_names(seg_clean).withColumn(
        "name_role",
        F.when(F.col("street") == F.col("full_street"), F.lit("full")).otherwise(F.lit("label")),
    )
    sides = by_name.select(
        "seg_ord", "physical_id", F.col("boro_code").alias("boro"), "street", "name_role",
        F.explode(F.array(_side(0, "R", "r", strict), _side(1, "L", "l", strict))).alias("s"),
    ).select("seg_ord", "physical_id", "boro", "street", "name_role", "s.*")
    usable = (
        (F.col("s_lo").isNotNull() & F.col("s_hi").isNotNull())
        | (F.col("lo1").isNotNull() & F.col("hi1").isNotNull()
           & F.col("lo2").isNotNull() & F.col("hi2").isNotNull())
    )
    return sides.where(F.col("boro").isNotNull() & usable).select(*SIDE_COLUMNS)
