"""Aggregations.

All are hash aggregates with a partial (map-side) step, so a hot key -- one
address, street or segment holding a large share of the rows -- is reduced
inside every map task before the shuffle and never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.schemas import year_columns

ADDRESS_KEYS = ["boro", "street", "n1", "n2", "parity"]


def pivot_years(df: DataFrame, group_cols: Sequence[str], years: Sequence[int],
                year_col: str = "year", missing_as_null: bool = False) -> DataFrame:
    """Group and count per year into one column per year, y<year> (A1, A2).

    Same result as ``groupBy(...).pivot(year, years).count()`` but planned as a
    single aggregate with conditional counts: one shuffle instead of the two
    (group+year, then group) that ``pivot`` plans. ``missing_as_null`` gives
    NULL, as ``pivot`` does, for a group without rows in a year; otherwise 0.
    """
    y = F.col(year_col)
    if missing_as_null:
        aggs = [F.sum(F.when(y == v, F.lit(1))).cast("bigint").alias(c)
                for v, c in zip(years, year_columns(years))]
    else:
        aggs = [F.count_if(y == v).alias(c) for v, c in zip(years, year_columns(years))]
    return df.groupBy(*group_cols).agg(*aggs)


def pivot_years_native(df: DataFrame, group_cols: Sequence[str], years: Sequence[int],
                       year_col: str = "year") -> DataFrame:
    """``pivot`` itself, for comparison; NULL where a group lacks a year."""
    out = df.groupBy(*group_cols).pivot(year_col, list(years)).count()
    for v, c in zip(years, year_columns(years)):
        out = out.withColumnRenamed(str(v), c)
    return out


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL counts become 0."""
    return df.na.fill(0, subset=list(cols))


def count_long(df: DataFrame, group_cols: Sequence[str], weight: str | None = None,
               out: str = "cnt") -> DataFrame:
    """Count (or sum a weight) per group."""
    agg = F.count(F.lit(1)) if weight is None else F.sum(weight).cast("bigint")
    return df.groupBy(*group_cols).agg(agg.alias(out))


def sum_by_id(df: DataFrame, cols: Sequence[str], key: str = "physical_id") -> DataFrame:
    """A3: sum every count column per id."""
    return df.groupBy(key).agg(*[F.sum(c).cast("bigint").alias(c) for c in cols])


def distinct_ids(segments: DataFrame, key: str = "physical_id") -> DataFrame:
    """A5."""
    return segments.select(key).distinct()


def zero_rows(ids: DataFrame, cols: Sequence[str], key: str = "physical_id") -> DataFrame:
    """One all-zero row per id."""
    return ids.select(key, *[F.lit(0).alias(c) for c in cols])


def max_merge(sums: DataFrame, zeros: DataFrame, cols: Sequence[str],
              key: str = "physical_id") -> DataFrame:
    """U2 + A4: positional union of sums and zero rows, max per id.

    Every id of ``zeros`` appears; since counts are >= 0 the max is the sum.
    """
    return (sums.select(key, *cols).union(zeros.select(key, *cols))
            .groupBy(key).agg(*[F.max(c).cast("bigint").alias(c) for c in cols]))


def totals_with_all_ids(matched: DataFrame, ids: DataFrame | None, cols: Sequence[str],
                        key: str = "physical_id") -> DataFrame:
    """Per-id totals of the count columns, with an all-zero row for ids of
    ``ids`` that had no match (J11 + A3 + A4 in one aggregate).

    The id rows are unioned in as zeros *before* the aggregation, so the
    zero-fill costs no join and no extra shuffle: one partial+final sum.
    """
    rows = matched.select(key, *[F.col(c).cast("bigint").alias(c) for c in cols])
    if ids is not None:
        rows = rows.unionByName(ids.select(key, *[F.lit(0).cast("bigint").alias(c) for c in cols]))
    return rows.groupBy(key).agg(*[F.sum(c).alias(c) for c in cols])
