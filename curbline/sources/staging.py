"""Parquet staging of the event table, partitioned by year.

CSV with quoted multi-line fields cannot be split (one task per file) and a
year predicate on text cannot prune anything. Staging once to Parquet,
partitioned by the issue year, gives split-able, column-pruned scans and
partition pruning for the year range of every later run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.functions import year_text


def stage_violations(violations: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Write events as Parquet under ``path``/issue_year=YYYY/.

    One shuffle rebalances the rows by year: small years share a task, a large
    one is split into tasks of the advisory partition size (adaptive
    execution), so the number of files follows the data, not scan tasks x years.
    """
    staged = violations.withColumn("issue_year", year_text("issue_date"))
    (staged.hint("rebalance", "issue_year").sortWithinPartitions("issue_year")
        .write.mode(mode).partitionBy("issue_year").parquet(path))
    return path


def read_staged_violations(spark: SparkSession, path: str,
                           years: Sequence[int] | None = None) -> DataFrame:
    """Staged events (schema VIOLATION); ``years`` prunes partitions."""
    df = spark.read.parquet(path)
    if years is not None:
        df = df.where(F.col("issue_year").between(min(years), max(years)))
    return df.drop("issue_year", "batch")
