"""Reject table, safe overwrite and the ingest of files with mixed headers."""

import os

import pytest
from given_tables import SF001
from pyspark.sql import functions as F

from curbline.operators import REJECT_REASONS, clean, read_kept, read_rejects, reject_malformed, split_malformed
from curbline.schemas import VIOLATION, VIOLATION_CSV_COLUMNS
from curbline.sources import csv as csv_io
from curbline.sources import fixtures, staging
from curbline.streaming import ingest_mixed_csvs


def test_counts_and_survivors_equal_the_input(spark, tmp_path):
    v = fixtures.violations(spark, SF001)
    seen = split_malformed(v, f"{tmp_path}/judged")
    assert list(seen) == ["kept", *REJECT_REASONS] and sum(seen.values()) == v.count()
    kept, out = read_kept(spark, f"{tmp_path}/judged"), read_rejects(spark, f"{tmp_path}/judged")
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(map(tuple, reject_malformed(v).collect()), key=str)
    counts = {r.reason: r["count"] for r in out.groupBy("reason").count().collect()}
    assert counts == {k: n for k, n in seen.items() if n and k != "kept"}
    assert "PartitionFilters: [isnotnull(rejected" in out._jdf.queryExecution().toString().replace("\n", " ")


def test_first_failing_check_is_the_reason(spark, tmp_path):
    rows = [(1, "12", "MAIN", "NY", "01/02/2016"), (2, None, "", "??", "x"), (3, "", "MAIN", "??", "x"), (4, "x", "MAIN", "??", "x"),
            (5, "x", "MAIN", "NY", "x"), (6, "12", "MAIN", "NY", "13/45/2016"), (None, None, None, None, None)]
    judged = clean.judge_facts(spark.createDataFrame(rows, VIOLATION)).collect()
    assert [r.reason for r in judged] == [None, "missing field", "empty field", "unknown county", "bad house number", "bad date", "missing field"]
    seen = split_malformed(spark.createDataFrame([], VIOLATION), f"{tmp_path}/none")
    assert sum(seen.values()) == 0
    with pytest.raises(Exception, match="(?i)exists"):
        split_malformed(spark.createDataFrame(rows, VIOLATION), f"{tmp_path}/none")


def test_failing_overwrite_leaves_the_old_report(spark, tmp_path):
    path, old = f"{tmp_path}/report", spark.range(5).select(F.col("id").cast("string").alias("a"))
    csv_io._write(old, path, "overwrite", True)
    boom = spark.range(100, numPartitions=4).select(F.when(F.col("id") < 99, F.col("id").cast("string")).otherwise(F.raise_error(F.lit("boom"))).alias("a"))
    with pytest.raises(Exception, match="boom"):
        csv_io._write(boom, path, "overwrite", True)
    read = lambda: sorted(r.a for r in spark.read.option("header", "true").csv(path).collect())
    assert read() == ["0", "1", "2", "3", "4"] and os.listdir(tmp_path) == ["report"]
    csv_io._write(spark.range(7, 9).select(F.col("id").cast("string").alias("a")), path, "overwrite", True)
    assert read() == ["7", "8"] and os.listdir(tmp_path) == ["report"]
    # a report made from the old one may replace it
    csv_io._write(spark.read.option("header", "true").schema("a string").csv(path).where("a > '7'"), path, "overwrite", True)
    assert read() == ["8"]


def _arrive(folder, name, order, ids, year):
    cells = {"Summons Number": str, "House Number": lambda i: "12", "Street Name": lambda i: '"MAIN\nST"', "Violation County": lambda i: "NY",
             "Issue Date": lambda i: f"01/02/{year}", "Plate": lambda i: "x"}
    text = ",".join(order) + "\n" + "".join(",".join(cells[c](i) for c in order) + "\n" for i in ids)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)


def test_mixed_headers_are_ingested_once(spark, tmp_path):
    names = list(VIOLATION_CSV_COLUMNS)
    src, out, ckpt = f"{tmp_path}/in", f"{tmp_path}/staged", f"{tmp_path}/ckpt"
    os.makedirs(src)
    _arrive(src, "a.csv", names, range(0, 10), 2015)
    _arrive(src, "b.csv", ["Plate", *names[::-1]], range(10, 30), 2016)
    assert ingest_mixed_csvs(spark, src, out, ckpt, multi_line="split") == 1
    rows = lambda: sorted(tuple(r) for r in staging.read_staged_violations(spark, out).select("vid", "street_name", "issue_date").collect())
    assert rows() == [(i, "MAIN\nST", f"01/02/{2015 if i < 10 else 2016}") for i in range(30)]
    assert ingest_mixed_csvs(spark, src, out, ckpt) == 0 and len(rows()) == 30
    _arrive(src, "c.csv", [names[2], "Plate", *names[:2], *names[3:]], range(30, 35), 2016)
    assert ingest_mixed_csvs(spark, src, out, ckpt) == 1 and [r[0] for r in rows()] == list(range(35))
    # the last batch runs again, as after a failure between its write and its commit
    for name in ("1", ".1.crc"):
        if os.path.exists(f"{ckpt}/commits/{name}"):
            os.remove(f"{ckpt}/commits/{name}")
    assert ingest_mixed_csvs(spark, src, out, ckpt) == 1 and [r[0] for r in rows()] == list(range(35))
    # files follow the data: one per year and batch here
    found = [f for _, _, fs in os.walk(out) for f in fs if f.endswith(".parquet")]
    assert len(found) == 3
    assert staging.read_staged_violations(spark, out, [2015]).count() == 10
    _arrive(src, "d.csv", names[:-1], [99], 2016)
    with pytest.raises(Exception, match="lacks column"):
        ingest_mixed_csvs(spark, src, out, ckpt)
    assert len(rows()) == 35
