"""Headers of CSV files, read without scanning the files.

Spark lists the files (in parallel, from many folders at once). The first line
of a few files is read by the driver; of many, by one short task per file that
ends after its first line.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

FEW = 32                    # files whose first line the driver reads itself


def csv_files(spark: SparkSession, path: str) -> list[str]:
    """Non-empty data files at ``path`` (file, folder with subfolders, or glob), by name."""
    try:
        # contents are not read: only the listing's columns are asked for
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from missing
        raise
    return sorted(r.path for r in found.where("length > 0").select("path").collect())


def first_line(spark: SparkSession, file: str) -> str:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(file)
    stream = where.getFileSystem(conf).open(where)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(where)
    if codec is not None:
        stream = codec.createInputStream(stream)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        return reader.readLine() or ""
    finally:
        reader.close()


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _first_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if len(batch):
            yield batch.slice(0, 1)
            return                      # the rest of the file is not read


def _lines_by_executors(spark: SparkSession, files: list[str]) -> list[tuple[str, list[str]]]:
    """(first line, its files): one task per file, whole files, one row at a time."""
    with _settings(spark, {"spark.sql.files.maxPartitionBytes": str(1 << 62), "spark.sql.files.openCostInBytes": str(1 << 60),
                           "spark.sql.execution.arrow.maxRecordsPerBatch": "1"}):
        first = (spark.read.text(files).select(F.col("_metadata.file_path").alias("file"), "value")
                 .mapInArrow(_first_row, "file string, value string"))
        rows = first.groupBy("value").agg(F.sort_array(F.collect_list("file")).alias("files")).collect()
    return sorted(((r.value, [unquote(f) for f in r.files]) for r in rows), key=lambda x: x[1])


def headers(spark: SparkSession, files: list[str]) -> dict[tuple[str, ...], list[str]]:
    """The files of each header (its column names in order), by first file."""
    found = ([(first_line(spark, f), [f]) for f in files] if len(files) <= FEW else _lines_by_executors(spark, files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for line, own in found:
        line = line.removeprefix("\ufeff").rstrip("\r\n")
        groups.setdefault(tuple(next(csv.reader([line]), [])), []).extend(own)
    return groups
