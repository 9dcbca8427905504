"""CSV scan and sink.

Scans keep every field as text (no inference pass) and select the used columns
by name, so the CSV parser only materialises those (CSV column pruning). Files
are grouped by their header line first: files of one folder may have other
column orders or more columns, each group is read with its own, and a file
that lacks a used column is an error. ``multi_line`` (quoted fields with
embedded newlines): True makes each file one task, ``"split"`` reads such files by
many tasks (``curbline.sources.records``), False is for files without line breaks in
fields. Large inputs should be staged to Parquet once
(``curbline.sources.staging``) and read from there.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline.schemas import (
    SEGMENT, SEGMENT_CSV_COLUMNS, VIOLATION, VIOLATION_CSV_COLUMNS, VIOLATION_CSV_POSITIONS,
    year_columns,
)
from curbline.session import scratch_path
from curbline.sources.headers import csv_files, headers
from curbline.sources.records import read_records

CSV_OPTIONS = {"header": "true", "escape": '"'}


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new output path in the cluster's shared folder."""
    return scratch_path(spark, label)


def _reader(spark: SparkSession, multi_line: bool):
    return (spark.read.options(**CSV_OPTIONS)
            .option("multiLine", str(multi_line).lower())
            .option("mode", "PERMISSIVE"))


def _scans(spark: SparkSession, path: str | list[str], multi_line: bool | str) -> list[DataFrame]:
    """One scan per header found at ``path``, its columns as text."""
    out = []
    if multi_line not in (True, False, "split"):
        raise ValueError(f"unknown form of multi_line {multi_line!r}")
    for header, files in headers(spark, csv_files(spark, path) if isinstance(path, str) else path).items():
        # a repeated name is told apart by its place, as an inferred schema would
        names = [f"{n}{i}" if header.count(n) > 1 else n for i, n in enumerate(header)]
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        out.append(read_records(spark, files, schema) if multi_line == "split"
                   else _reader(spark, multi_line).schema(schema).csv(files))
    return out


def _select(raw: DataFrame, mapping: dict[str, str], casts: dict[str, str], may_lack: str | None = None) -> DataFrame:
    cols = []
    for source, name in mapping.items():
        if source in raw.columns:
            c = F.col(f"`{source}`")
            cols.append((c.try_cast(casts[name]) if name in casts else c).alias(name))
        elif name == may_lack:
            cols.append(F.lit(None).cast(casts[name]).alias(name))
        else:
            raise ValueError(f"CSV input lacks column {source!r}; a file has {raw.columns}")
    return raw.select(*cols)


def _union(frames: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, frames)


def read_violations_csv(spark: SparkSession, path: str | list[str], multi_line: bool | str = True,
                        by_position: bool = False) -> DataFrame:
    """A directory, a file or a list of files of event CSVs -> schema VIOLATION.

    Columns are found by each file's own header names, or with ``by_position``
    at the fixed positions of the public layout (S3); the header line is
    skipped either way. No files with data give no rows.
    """
    raws = _scans(spark, path, multi_line)
    if not raws:
        return spark.createDataFrame([], VIOLATION)
    if by_position:
        return _union([raw.select(*[
            (F.col(f"`{raw.columns[VIOLATION_CSV_POSITIONS[name]]}`").try_cast("bigint") if name == "vid"
             else F.col(f"`{raw.columns[VIOLATION_CSV_POSITIONS[name]]}`")).alias(name)
            for name in VIOLATION_CSV_COLUMNS.values()]) for raw in raws])       # schema order
    # an absent event id is the row's place: unique, all that is asked of it
    out = _union([_select(raw, VIOLATION_CSV_COLUMNS, {"vid": "bigint"}, may_lack="vid") for raw in raws])
    if all("Summons Number" in raw.columns for raw in raws):
        return out
    return out.withColumn("vid", F.coalesce("vid", F.monotonically_increasing_id()))


def read_segments_csv(spark: SparkSession, path: str, multi_line: bool | str = True) -> DataFrame:
    """Segment CSVs -> schema SEGMENT.

    Without an order column (``OBJECTID``) rows are numbered by file name and
    by their place in the file, however many files or splits there are.
    """
    casts = {"seg_ord": "bigint", "physical_id": "bigint", "boro_code": "int"}
    raws = _scans(spark, path, multi_line)
    if not raws:
        return spark.createDataFrame([], SEGMENT)
    if all("OBJECTID" in raw.columns for raw in raws):
        return _union([_select(raw, SEGMENT_CSV_COLUMNS, casts) for raw in raws])
    if any("OBJECTID" in raw.columns for raw in raws):
        raise ValueError("some segment files have the order column 'OBJECTID' and some lack it")
    if multi_line == "split":
        raise ValueError("rows without the order column 'OBJECTID' are numbered by place: read them with multi_line=True")
    return _in_file_order(_union([
        _select(raw, SEGMENT_CSV_COLUMNS, casts, may_lack="seg_ord").select(
            "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split"))
        for raw in raws]), "seg_ord")


def _in_file_order(rows: DataFrame, number: str) -> DataFrame:
    """Numbers rows by (file, place in the file). Only the splits' row counts,
    one row per split, pass through one task; the rows do not move."""
    placed = rows.withColumn("_place", F.monotonically_increasing_id())
    splits = placed.groupBy("_file", "_split").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_file", "_split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("_file", "_split", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    return (placed.join(splits, ["_file", "_split"])
            .withColumn(number, F.col("_before") + F.col("_place") - F.col("_first"))
            .select(*[c for c in rows.columns if not c.startswith("_")]))


def _write(df: DataFrame, path: str, mode: str, header: bool) -> str:
    def put(where: str, how: str) -> None:
        df.write.mode(how).option("header", str(header).lower()).option("escape", '"').csv(where)

    if mode == "overwrite":
        _replace(df.sparkSession, path, lambda aside: put(aside, "errorifexists"))
    else:
        put(path, mode)
    return path


def _replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Write beside ``path`` and swap by two renames once the job is done.

    Spark's own overwrite deletes the old output before the job runs. Here it
    stays readable until the new one is complete, and a failing job leaves it as it is; if
    the second rename fails, the old output is put back. A folder's name changes at
    once on HDFS and local disks; object stores copy.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    mark = uuid.uuid4().hex[:12]
    # hidden names: no reader of the parent folder sees them
    aside, old = (hadoop.Path(target.getParent(), f"_{target.getName()}-{kind}-{mark}") for kind in ("new", "old"))
    try:
        write(aside.toString())
        kept = fs.exists(target)
        if kept and not fs.rename(target, old):
            raise OSError(f"cannot move {path} aside")
        if not fs.rename(aside, target):
            if kept:
                fs.rename(old, target)
            raise OSError(f"cannot move the new output to {path}")
    finally:
        fs.delete(aside, True)
    fs.delete(old, True)


def write_violations_csv(violations: DataFrame, path: str, mode: str = "errorifexists") -> str:
    back = {v: k for k, v in VIOLATION_CSV_COLUMNS.items()}
    return _write(violations.select(*[F.col(c).alias(back[c]) for c in violations.columns]),
                  path, mode, header=True)


def write_segments_csv(segments: DataFrame, path: str, mode: str = "errorifexists") -> str:
    back = {v: k for k, v in SEGMENT_CSV_COLUMNS.items()}
    return _write(segments.select(*[F.col(c).alias(back[c]) for c in segments.columns]),
                  path, mode, header=True)


def write_report_csv(report: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """The report without header; 'errorifexists' fails if ``path`` exists, 'overwrite'
    swaps a complete new report for the old one."""
    return _write(report, path, mode, header=False)


def report_schema(years: Sequence[int]) -> T.StructType:
    return T.StructType(
        [T.StructField("physical_id", T.LongType())]
        + [T.StructField(c, T.LongType()) for c in year_columns(years)]
        + [T.StructField("ols_coeff", T.DoubleType())])


def read_report_csv(spark: SparkSession, path: str, years: Sequence[int]) -> DataFrame:
    """Read a written report back (headerless, fixed schema)."""
    return spark.read.schema(report_schema(years)).option("escape", '"').csv(path)
