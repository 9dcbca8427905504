"""Cleaning of events and segments.

Only narrow projections and filters: Catalyst pushes them into the scan, and
the output stays hash-partitioning-free (no shuffle here).
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from curbline.functions import (
    borough_code, number_part, parity, recode_county, strip_letters,
    upper_street, whole_number, year_parsed, year_text,
)

FACT_RAW = ["house_number", "street_name", "county", "issue_date"]
SEGMENT_RAW = ["physical_id", "l_low_hn", "l_high_hn", "r_low_hn", "r_high_hn",
               "full_street", "st_label", "boro_code"]
BOUNDS = ["l_low_hn", "l_high_hn", "r_low_hn", "r_high_hn"]


def drop_null_facts(violations: DataFrame) -> DataFrame:
    """Rows with a NULL in any of the four used columns are dropped."""
    return violations.na.drop(subset=FACT_RAW)


def project_facts(violations: DataFrame, keep_id: bool = True) -> DataFrame:
    """Only the used columns (plus the row id when kept)."""
    cols = (["vid"] if keep_id else []) + FACT_RAW
    return drop_null_facts(violations).select(*cols)


def clean_facts(
    violations: DataFrame,
    years: Sequence[int] | None = None,
    aliases: str = "final",
    year_mode: str = "text",
    strict_county: bool = False,
) -> DataFrame:
    """Cleaned events, one row per input row that survives.

    Columns: vid, street, house, county (recoded text), boro (int or NULL),
    n1, n2, parity, year.

    ``year_mode`` 'text' takes the third '/' part (F7); 'parsed' validates the
    date (F8). ``years`` keeps only that inclusive range (P5). With
    ``strict_county`` rows whose county is not a known code are dropped (P7).
    """
    year_fn = {"text": year_text, "parsed": year_parsed}[year_mode]
    house = strip_letters("house_number")
    df = drop_null_facts(violations).select(
        "vid",
        upper_street("street_name").alias("street"),
        house.alias("house"),
        recode_county("county", aliases).alias("county"),
        borough_code("county", aliases).alias("boro"),
        number_part(house, 0).alias("n1"),
        number_part(house, 1).alias("n2"),
        year_fn("issue_date").alias("year"),
    )
    df = df.withColumn("parity", parity("n1", "n2"))
    if strict_county:
        df = df.where(F.col("boro").isNotNull())
    if years is not None:
        df = df.where(F.col("year").between(min(years), max(years)))
    return df


def matchable(facts: DataFrame) -> DataFrame:
    """Rows that can match some segment: borough code and first number known.

    Every match condition compares both, so the rest is pruned before any
    aggregation or join.
    """
    return facts.where(F.col("boro").isNotNull() & F.col("n1").isNotNull())


# why an event is rejected, in the order in which the checks are made
REJECT_REASONS = ["missing field", "empty field", "unknown county", "bad house number", "bad date"]


_JUDGED = ("vid bigint, house_number string, street_name string, county string, issue_date string, "
           "boro int, n1 int, n2 int, year int, reason string, rejected int")


def judge_facts(violations: DataFrame, aliases: str = "no_pbx") -> DataFrame:
    """Every event with its parsed fields and the first check it fails.

    Columns: vid, the four raw fields, boro, n1, n2, year, reason (one of
    ``REJECT_REASONS``; NULL for an event that is kept). Rows are never dropped and
    no row raises an error.
    """
    house = strip_letters("house_number")
    parsed = violations.select(
        "vid", *FACT_RAW, borough_code("county", aliases).alias("boro"), number_part(house, 0).alias("n1"),
        number_part(house, 1).alias("n2"), year_parsed("issue_date").alias("year"))
    any_of = lambda test: functools.reduce(Column.__or__, [test(F.col(c)) for c in FACT_RAW])
    checks = [any_of(Column.isNull), any_of(lambda c: c == ""), F.col("boro").isNull(), F.col("n1").isNull(), F.col("year").isNull()]
    reason = F.coalesce(*[F.when(check, F.lit(name)) for check, name in zip(checks, REJECT_REASONS)])
    return parsed.withColumn("reason", reason)


def reject_malformed(violations: DataFrame, aliases: str = "no_pbx") -> DataFrame:
    """Keep rows whose fields are present, non-empty and parse.

    Columns: vid, boro, n1, n2, year. A row is rejected (not an error) when the
    county is unknown, the date is not a valid date or the house number's
    first part is not a number.
    """
    return judge_facts(violations, aliases).where(F.col("reason").isNull()).select("vid", "boro", "n1", "n2", "year")


def split_malformed(violations: DataFrame, path: str, aliases: str = "no_pbx") -> dict[str, int]:
    """Write kept and rejected events below ``path`` in one pass and count them.

    Returns {"kept": n, reason: n, ...} of every reason, observed while writing: the
    counts add up to the input rows. ``read_kept`` and ``read_rejects`` read the two.
    """
    judged = judge_facts(violations, aliases)
    seen = Observation()
    counts = [F.count_if(F.col("reason").isNull()).alias("kept")]
    counts += [F.count_if(F.coalesce(F.col("reason") == r, F.lit(False))).alias(r) for r in REJECT_REASONS]
    (judged.observe(seen, *counts).withColumn("rejected", F.col("reason").isNotNull().cast("int"))
     .write.mode("errorifexists").partitionBy("rejected").parquet(path))
    return seen.get


def read_kept(spark: SparkSession, path: str) -> DataFrame:
    """What ``split_malformed`` kept: vid, boro, n1, n2, year (one partition is read)."""
    return spark.read.schema(_JUDGED).parquet(path).where("rejected = 0").select("vid", "boro", "n1", "n2", "year")


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The reject table: vid, the raw fields, reason (one partition is read)."""
    return spark.read.schema(_JUDGED).parquet(path).where("rejected = 1").select("vid", *FACT_RAW, "reason")


def clean_segments(segments: DataFrame, drop_nulls: bool = True) -> DataFrame:
    """Segments with parsed bounds (P3, F3-F5), street names upper-cased.

    ``drop_nulls`` drops rows with a NULL in any used column (P3); without it
    (P18) such rows stay and their NULL bounds simply never match.
    Each bound X becomes X_1, X_2 (parts of 'a-b') and X_0 (the whole text as
    a number, NULL when compound).
    """
    df = segments.select("seg_ord", *SEGMENT_RAW)
    if drop_nulls:
        df = df.na.drop(subset=SEGMENT_RAW)
    parsed = []
    for b in BOUNDS:
        parsed += [number_part(b, 0).alias(f"{b}_1"), number_part(b, 1).alias(f"{b}_2"),
                   whole_number(b).alias(f"{b}_0")]
    return df.select(
        "seg_ord", "physical_id", "boro_code",
        upper_street("full_street").alias("full_street"),
        upper_street("st_label").alias("st_label"),
        *parsed,
    )


def with_street_names(seg_clean: DataFrame) -> DataFrame:
    """Each segment row once per distinct non-NULL street name (``street``)."""
    names = F.filter(F.array_distinct(F.array("full_street", "st_label")),
                     lambda x: x.isNotNull())
    return seg_clean.select("*", F.explode(names).alias("street"))


def dedupe_labels(seg_clean: DataFrame) -> DataFrame:
    """One row per (segment row, distinct non-NULL street name).

    A label equal to the full name is kept once, so a match is never counted
    twice for the same segment row.
    """
    return with_street_names(seg_clean).select("seg_ord", "physical_id", "street")
