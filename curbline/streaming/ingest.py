"""Exactly-once, incremental CSV -> Parquet staging with an availableNow trigger."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline.functions import year_text
from curbline.schemas import VIOLATION_CSV_COLUMNS
from curbline.session import shared_dir
from curbline.sources.csv import read_violations_csv
from curbline.sources.headers import csv_files, headers
from curbline.sources.staging import stage_violations


def _columns(spark: SparkSession, source_dir: str) -> tuple[str, ...]:
    found = headers(spark, csv_files(spark, source_dir))
    if len(found) != 1:
        shown = "; ".join(f"{files[0]}: {', '.join(h)}" for h, files in found.items())
        raise ValueError("a stream needs files of one header, found "
                         + (f"{len(found)} ({shown})" if found else "no file with data"))
    return next(iter(found))


def _batches(spark: SparkSession, checkpoint: str) -> int:
    """Batches committed so far, by the commit log's last number."""
    where = spark._jvm.org.apache.hadoop.fs.Path(checkpoint + "/commits")
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
    return max((int(n) + 1 for n in names if n.isdigit()), default=0)


def ingest_violation_csvs(
    spark: SparkSession,
    source_dir: str,
    staged_path: str,
    csv_columns: Sequence[str] | None = None,
    checkpoint: str | None = None,
    max_files_per_trigger: int | None = None,
    multi_line: bool = True,
) -> int:
    """Append every not-yet-ingested CSV file of ``source_dir`` to ``staged_path``.

    ``csv_columns`` are the header names in file order (a streaming scan needs
    its schema up front; every field is read as text); by default they are read
    from the files, which must agree. Every file's header is checked against
    them while it is read: another order or other names stop the stream with an
    error instead of landing in the wrong columns. ``multi_line=False`` lets
    files without line breaks in fields be split over many tasks.

    The file log in the checkpoint (default: below the shared folder, keyed by
    the target path) makes repeated calls ingest each file exactly once, also
    after a failure. Returns the number of micro-batches committed.
    """
    csv_columns = tuple(csv_columns or _columns(spark, source_dir))
    missing = [c for c in VIOLATION_CSV_COLUMNS if c not in csv_columns]
    if missing:
        raise ValueError(f"streaming ingest needs the columns {missing}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in csv_columns])
    reader = (spark.readStream.schema(schema)
              .option("header", "true").option("enforceSchema", "false").option("escape", '"')
              .option("multiLine", str(multi_line).lower()))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.csv(source_dir)
    events = raw.select(*[
        (F.col(f"`{src}`").try_cast("bigint") if dst == "vid" else F.col(f"`{src}`")).alias(dst)
        for src, dst in VIOLATION_CSV_COLUMNS.items()])
    staged = events.withColumn("issue_year", year_text("issue_date"))
    if checkpoint is None:
        key = hashlib.sha256(staged_path.encode()).hexdigest()[:16]
        checkpoint = f"{shared_dir(spark)}/ingest-{key}"
    before = _batches(spark, checkpoint)
    query = (staged.writeStream.format("parquet")
             .option("path", staged_path)
             .option("checkpointLocation", checkpoint)
             .partitionBy("issue_year")
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return _batches(spark, checkpoint) - before


def ingest_mixed_csvs(
    spark: SparkSession,
    source_dir: str,
    staged_path: str,
    checkpoint: str | None = None,
    max_files_per_trigger: int | None = None,
    multi_line: bool | str = True,
) -> int:
    """Append every not-yet-ingested CSV file of ``source_dir``, whatever its columns' order.

    The stream's rows are new files, not lines: each micro-batch reads its files as
    the batch scan does (grouped by header, a file without a used column is an
    error; ``multi_line`` as there), rebalances them by year and writes below
    ``staged_path``/batch=N. A batch that runs again after a failure replaces its own
    folder, so it adds nothing. Read with ``read_staged_violations``.

    Returns the number of micro-batches committed; the file log is kept as in
    ``ingest_violation_csvs``.
    """
    if checkpoint is None:
        key = hashlib.sha256(staged_path.encode()).hexdigest()[:16]
        checkpoint = f"{shared_dir(spark)}/ingest-mixed-{key}"
    reader = (spark.readStream.format("binaryFile").option("recursiveFileLookup", "true")
              .schema("path string, modificationTime timestamp, length bigint, content binary"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))

    def add(files, batch: int) -> None:
        names = sorted(r.path for r in files.collect())       # this batch's file names
        events = read_violations_csv(files.sparkSession, names, multi_line)
        stage_violations(events, f"{staged_path.rstrip('/')}/batch={batch}", mode="overwrite")

    before = _batches(spark, checkpoint)
    # contents are not read here: only the names are asked for
    query = (reader.load(source_dir).where("length > 0").select("path").writeStream
             .foreachBatch(add)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return _batches(spark, checkpoint) - before
