"""CSV records with line breaks in fields, read by many tasks per file.

Spark's CSV reader gives a file with such records to one task. Here the files
are read as lines, which splits anywhere, and the records are found again:

1. ``split_states``: whether a line starts inside a quoted field depends on all
   text before it. What a split's lines do to that one bit is a function of two
   states, so every split is read at once, and the functions are composed per
   file in order (one narrow row per split reaches the driver).
2. ``records``: with its first state known, a task joins its own lines to records.
   Only a record that goes on in the next split is handed on in parts; the
   parts are put together in a second, small step over the files that have any.
3. ``from_csv`` parses the records in the JVM.

Quotes are read as Spark's CSV reader does with ``escape='"'``: a field is quoted if
it begins with a quote, a doubled quote is one inside it, text after the
closing quote runs on to the delimiter, other quotes are plain characters. Line
breaks in a field are kept as they are ("\\r\\n" too).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE, BEGUN, WITHIN, ENDED = range(4)      # a record, or the part of one that a split has
MOST_SPLITS = 4_000_000                     # narrow rows the driver may get


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted field is open after ``line``, if one was (or was not) before it."""
    at = 0
    while True:
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True
            if line.startswith('"', at + 1):
                at += 2
                continue
            inside = False
        elif line.startswith('"', at):
            inside, at = True, at + 1
            continue
        at = line.find(",", at) + 1
        if not at:
            return False


def _fixed_splits(spark: SparkSession, files: list[str]) -> SparkSession:
    """A session in which ``files``, or some of them, are always split alike.

    Spark's split size follows the bytes of the files that one scan selects and the
    cores there are at that moment, so a scan of the few files with cut records had other
    splits than the scan before. A table keeps the session it was read in.
    """
    conf = spark.conf
    most, least = (int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(conf.get(f"spark.sql.files.{k}")))
                   for k in ("maxPartitionBytes", "openCostInBytes"))
    tasks = int(conf.get("spark.sql.files.minPartitionNum", None) or spark.sparkContext.defaultParallelism)
    total = spark.read.format("binaryFile").load(files).agg(F.sum("length")).first()[0] or 0
    fixed = spark.newSession()
    fixed.conf.set("spark.sql.files.minPartitionNum", "1")
    fixed.conf.set("spark.sql.files.openCostInBytes", str(least))
    fixed.conf.set("spark.sql.files.maxPartitionBytes", str(min(most, max(1, least, -(-total // tasks)))))
    return fixed


def _lines(spark: SparkSession, files: Iterable[str]) -> DataFrame:
    # "\n" alone ends a line, so that a field keeps its own "\r"
    return spark.read.option("lineSep", "\n").text(list(files)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[object, int, int, int]]:
    """(file, split start, from, to) of a batch's rows of one split each."""
    file, start = batch.column(0), batch.column(1)
    n = len(batch)
    if not n:
        return
    change = pc.or_(pc.not_equal(file.slice(1), file.slice(0, n - 1)), pc.not_equal(start.slice(1), start.slice(0, n - 1)))
    cuts = [0, *[i + 1 for i in pc.indices_nonzero(change).to_pylist()], n]
    for lo, hi in zip(cuts, cuts[1:]):
        yield file[lo].as_py(), start[lo].as_py(), lo, hi


def _transitions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split: the state after it from outside and from inside, and whether a line leaves outside open."""
    found: dict = {}
    for batch in batches:
        quoted = batch.column(2)
        for file, start, lo, hi in _runs(batch):
            out, inn, opened = found.get((file, start), (False, True, False))
            for line in quoted.slice(lo, hi - lo).drop_null().to_pylist():
                same = out == inn
                out = ends_inside(line, out)
                inn = out if same else ends_inside(line, inn)
                opened = opened or out or inn
            found[file, start] = out, inn, opened
    if found:
        keys, values = list(zip(*found)), list(zip(*found.values()))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*keys, *values)], ["file", "start", "out", "inn", "opened"])


def split_states(spark: SparkSession, files: Iterable[str]) -> dict[int, dict[int, tuple[bool, bool, bool]]]:
    """{file key: {split start: (inside at its start, inside at its end, any line ends inside)}}.

    File keys are xxhash64 of the file's path as Spark names it.
    """
    marked = _lines(spark, files).select(F.xxhash64("file").alias("file"), "start", F.when(F.col("line").contains('"'), F.col("line")).alias("line"))
    each = marked.mapInArrow(_transitions, "file bigint, start bigint, out boolean, inn boolean, opened boolean")
    rows = each.limit(MOST_SPLITS + 1).collect()
    if len(rows) > MOST_SPLITS:
        raise ValueError(f"over {MOST_SPLITS} splits: raise spark.sql.files.maxPartitionBytes")
    states: dict[int, dict[int, tuple[bool, bool, bool]]] = {}
    inside: dict[int, bool] = {}
    for r in sorted(rows, key=lambda r: (r.file, r.start)):
        before = inside.get(r.file, False)
        inside[r.file] = after = r.inn if before else r.out
        states.setdefault(r.file, {})[r.start] = before, after, r.opened
    return states


def _joined(states: dict[int, dict[int, tuple[bool, bool, bool]]], only_parts: bool):
    """Task function: (file, start, line) in file order -> (file, start, part, record)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, inside, part, held, header = None, False, WHOLE, [], False

        for batch in batches:
            text = batch.column(2)
            quoted = pc.match_substring(text, '"')
            out: list[tuple] = []
            for file, start, lo, hi in _runs(batch):
                if (file, start) != split:
                    if held:
                        out.append((*split, WITHIN if part == ENDED else BEGUN, "\n".join(held)))
                    known = states.get(file, {}).get(start)
                    if known is None:
                        raise RuntimeError("the files' splits changed between two scans (executors left or files grew); run again, "
                                           "or fix spark.sql.files.minPartitionNum")
                    split, inside, held = (file, start), known[0], []
                    part, header = ENDED if inside else WHOLE, start == 0
                marks, lines = quoted.slice(lo, hi - lo).to_pylist(), text.slice(lo, hi - lo).to_pylist()
                for line, quote in zip(lines, marks):
                    if quote:
                        inside = ends_inside(line, inside)
                    if held or inside or part == ENDED:
                        held.append(line)
                        if inside:
                            continue
                        line, held = "\n".join(held), []
                    if header:
                        header = False
                    elif part == ENDED:
                        out.append((*split, ENDED, line))
                    elif not only_parts:
                        out.append((*split, WHOLE, line))
                    part = WHOLE
            if out:
                yield _batch(out, only_parts)
        if held:
            yield _batch([(*split, WITHIN if part == ENDED else BEGUN, "\n".join(held))], only_parts)

    def _batch(rows: list[tuple], parts: bool) -> pa.RecordBatch:
        kept = [r for r in rows if (r[2] != WHOLE) == parts]
        cols = list(zip(*kept)) if kept else [[], [], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.string()))],
                                          ["file", "start", "part", "record"])

    return run


def records(spark: SparkSession, files: list[str]) -> DataFrame:
    """(``record``) of every data record of ``files`` (the first one of each file, its header, is left out).

    Reads the files once to find the states (at once), and once more for the
    records. Blank records are dropped, as by Spark's reader.
    """
    fixed = _fixed_splits(spark, files)
    states = split_states(fixed, files)
    # the union with no rows makes it a table of the caller's session
    lines = spark.createDataFrame([], "file string, start bigint, line string").union(_lines(fixed, files))
    cut = {f for f, s in states.items() if any(before for before, _, _ in s.values())}

    def scan(wanted: DataFrame, only_parts: bool) -> DataFrame:
        keyed = wanted.select(F.xxhash64("file").alias("file"), "start", "line")
        return keyed.mapInArrow(_joined(states, only_parts), "file bigint, start bigint, part int, record string")

    found = scan(lines, False).select("record")
    if cut:
        # the files with a record over a split's end; Spark's own names give the keys
        hit = F.xxhash64("file").isin(*sorted(cut)) if len(cut) <= 1000 else F.lit(True)
        parts = scan(lines.where(hit), True)
        order = Window.partitionBy("file").orderBy("start", "place").rowsBetween(Window.unboundedPreceding, 0)
        # within a split the end of the last record comes before the beginning of the next
        placed = parts.withColumn("place", (F.col("part") == BEGUN).cast("int")).withColumn(
            "number", F.sum((F.col("part") == BEGUN).cast("long")).over(order))
        whole = placed.groupBy("file", "number").agg(F.sort_array(F.collect_list(F.struct("start", "place", "record"))).alias("parts"))
        found = found.union(whole.where("number > 0").select(F.array_join(F.col("parts.record"), "\n").alias("record")))
    ended = F.when(F.col("record").endswith("\r"), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    return found.select(ended.alias("record")).where(F.trim("record") != "")


def read_records(spark: SparkSession, files: list[str], schema: T.StructType) -> DataFrame:
    """The files' records with ``schema`` (all text), parsed in the JVM."""
    row = F.from_csv("record", _ddl(schema), {"escape": '"', "mode": "PERMISSIVE"})
    return records(spark, files).select(row.alias("r")).select("r.*")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema.fields)
