"""Multi-line CSV records over many splits, against Spark's one-task-per-file reader."""

import random

import pytest
from pyspark.sql import types as T

from curbline.sources import csv as csv_io
from curbline.sources import headers, records


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    with headers._settings(spark, keys):
        yield


def both(spark, folder, n):
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(n)])
    files = headers.csv_files(spark, str(folder))
    want = spark.read.options(**csv_io.CSV_OPTIONS).option("multiLine", "true").schema(schema).csv(files)
    got = records.read_records(spark, files, schema)
    # Spark's reader turns a field's "\r\n" into "\n" in files whose lines end so; here it is kept
    plain = lambda df: sorted((tuple(v and v.replace("\r\n", "\n") for v in r) for r in df.collect()), key=str)
    return plain(got), plain(want), got


def test_state_of_a_line():
    inside = records.ends_inside
    assert not inside("a,b", False) and inside("a,b", True)
    assert inside('a,"b', False) and not inside('b",c', True)
    assert not inside('"a","b"', False) and inside('a","b', True)
    assert not inside('5" pipe,x', False)               # a quote inside a plain field is a character
    assert inside('"a""', False) and not inside('"a"""', False)
    assert not inside('"a"b"c,d', False)                # text after the closing quote runs to the delimiter
    assert inside('', True) and not inside('', False)


def test_same_rows_as_one_task_per_file(spark, small_splits, tmp_path):
    rng = random.Random(1)
    cell = lambda: rng.choice(["", "x", "plain text", '"a\nb"', '"say ""hi""\r\n,\n"', '"' + "long\n" * 120 + '"', '5" pipe', '"q"', "é ü", '"\n\n"'])
    for f in range(4):
        end = rng.choice(["\n", "\r\n"])
        body = "".join(f"{f}-{i}," + ",".join(cell() for _ in range(3)) + end for i in range(150))
        (tmp_path / f"f {f}.csv").write_text("c0,c1,c2,c3" + end + body, encoding="utf-8", newline="")
    got, want, df = both(spark, tmp_path, 4)
    assert got == want and len(got) == 600
    assert df.rdd.getNumPartitions() > 50


def test_record_over_many_splits_and_open_end(spark, small_splits, tmp_path):
    big = "x\n" * 2000                                   # one field of dozens of splits
    (tmp_path / "a.csv").write_text(f'c0,c1\n1,"{big}"\n2,b\n\n3,"{big}"', newline="")
    (tmp_path / "b.csv").write_text("c0,c1\n", newline="")
    (tmp_path / "c.csv").write_text("", newline="")
    (tmp_path / "d.csv").write_text('c0,c1\n9,last', newline="")
    got, want, _ = both(spark, tmp_path, 2)
    assert got == want and len(got) == 4
    assert sum(len(r[1]) for r in got) > 2 * len(big)


def test_changed_splits_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("c0,c1\n" + '1,"a\nb"\n' * 300, newline="")
    keys = {"spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    with headers._settings(spark, {**keys, "spark.sql.files.maxPartitionBytes": "1000"}):
        found = records.records(spark, headers.csv_files(spark, str(tmp_path)))
        assert found.count() == 300
    with headers._settings(spark, {**keys, "spark.sql.files.maxPartitionBytes": "700"}):
        found = found.select("*")
        try:
            assert found.count() == 300                  # same splits are still planned: right, or refused
        except Exception as refused:                     # noqa: BLE001
            assert "splits changed" in str(refused)


def test_many_files_are_headed_by_executors(spark, tmp_path):
    for i in range(60):
        names = ["Summons Number", "House Number", "Street Name", "Violation County", "Issue Date"]
        values = [str(i), f"{i}", "MAIN ST", "NY", "01/02/2016"]
        if i % 2:
            names, values = names[::-1], values[::-1]
        (tmp_path / f"part {i:03d}.csv").write_text("﻿" * (i % 3 == 0) + ",".join(names) + "\r\n" + ",".join(values) + "\r\n", newline="")
    files = headers.csv_files(spark, str(tmp_path))
    assert len(files) == 60
    by_driver = {}
    for f in files:
        by_driver.setdefault(headers.first_line(spark, f).removeprefix("﻿").split(",")[0], set()).add(f.rsplit("/", 1)[1])
    found = headers.headers(spark, files)
    assert {k[0]: {f.rsplit("/", 1)[1] for f in v} for k, v in found.items()} == by_driver
    for form in (True, "split"):
        rows = csv_io.read_violations_csv(spark, str(tmp_path), multi_line=form).orderBy("vid").collect()
        assert [r.vid for r in rows] == list(range(60)) and {r.street_name for r in rows} == {"MAIN ST"}
    with pytest.raises(FileNotFoundError):
        headers.csv_files(spark, str(tmp_path / "none"))


def test_few_files_with_cut_records_keep_their_splits(spark, tmp_path):
    # one file of many has records over a split's end: its second scan selects it alone
    (tmp_path / "a.csv").write_text("c0,c1\n" + '1,"' + "ab\n" * 60 + '"\n' * 1 + '2,"x\ny"\n' * 400, newline="")
    for i in range(9):
        (tmp_path / f"b{i}.csv").write_text("c0,c1\n" + "3,plain\n" * 400, newline="")
    with headers._settings(spark, {"spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "20"}):
        got, want, _ = both(spark, tmp_path, 2)
    assert got == want and len(got) == 401 + 9 * 400
