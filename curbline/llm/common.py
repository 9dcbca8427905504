"""Helpers shared by the training-data operators.

Intermediate tables go to the folder that the session names in
``spark.checkpoint.dir`` (``curbline.session``), so a lost executor never takes
them along, and a reread table starts with no lineage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curbline.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables, whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Spark removes the shuffle files of a query at its end, not when the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it again.

    The shuffle files of the write are not kept: what follows reads the table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path  # plain attribute: lets ``forget`` remove it
    return out


def forget(df: DataFrame) -> None:
    """Remove a table that ``written`` made and that no later step reads."""
    path = getattr(df, "written_path", None)
    if path:
        jvm = df.sparkSession._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def only(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns; any others (whatever their names) are left out."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a number of its own for every row (column ``name``, bigint).

    The number is the row's place in its stored file, and the file's place among
    the table's files by name: it does not depend on how a scan is split, so
    a plan that runs again, on fewer executors, gives each row the same one.
    What is not read from Parquet files is written first.
    """
    try:
        docs.select("_metadata.row_index", "_metadata.file_path")
    except AnalysisException:
        docs = written(docs, "numbered")
    file, at = fresh_name(docs, "__file"), fresh_name(docs, "__at")
    files = docs.select(F.col("_metadata.file_path").alias(file)).distinct()
    files = written(files.withColumn(at, F.row_number().over(Window.orderBy(file)).cast("long")), "files")
    placed = docs.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(name))
    return (placed.join(sized_broadcast(files, files.count(), 512), file)
            .withColumn(name, F.shiftleft(at, 40).bitwiseOR(F.col(f"`{name}`"))).drop(file, at))


def sized_broadcast(df: DataFrame, rows: int, row_bytes: int, limit: int = 8 << 20) -> DataFrame:
    """Broadcast hint only when ``rows`` x ``row_bytes`` (both known) is in bounds."""
    return F.broadcast(df) if rows * row_bytes <= limit else df
