"""Incremental ingest: each arriving file lands once in the staging table."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from given_tables import SF001
from curbline.sources import csv as csv_io
from curbline.sources import fixtures, staging
from curbline.streaming import ingest_violation_csvs


def test_incremental_ingest_exactly_once(spark):
    root = tempfile.mkdtemp(prefix="curbline-stream-")
    src, out, ckpt = (os.path.join(root, x) for x in ("in", "staged", "ckpt"))
    v = fixtures.violations(spark, SF001)
    year = F.get(F.split("issue_date", "/"), F.lit(2))
    first = v.where(year <= "1997")
    later = v.where((year > "1997") | year.isNull())
    csv_io.write_violations_csv(first, os.path.join(src, "batch1"))
    ingest_violation_csvs(spark, src + "/*", out, checkpoint=ckpt)
    assert staging.read_staged_violations(spark, out).count() == first.count()
    # nothing new: nothing added
    ingest_violation_csvs(spark, src + "/*", out, checkpoint=ckpt)
    assert staging.read_staged_violations(spark, out).count() == first.count()
    csv_io.write_violations_csv(later, os.path.join(src, "batch2"))
    ingest_violation_csvs(spark, src + "/*", out, checkpoint=ckpt)
    back = staging.read_staged_violations(spark, out)
    assert sorted(back.select(*v.columns).collect()) == sorted(v.collect())
    pruned = staging.read_staged_violations(spark, out, (1995, 1995))
    assert pruned.count() == v.where(year == "1995").count()


HEAD = "Violation County,Summons Number,Issue Date,House Number,Street Name\n"


def write_csv(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_header_order_comes_from_the_files(spark):
    root = tempfile.mkdtemp(prefix="curbline-stream-")
    write_csv(f"{root}/in/a.csv", HEAD + "MN,1,06/25/2016,14,MAIN ST\n")
    assert ingest_violation_csvs(spark, f"{root}/in", f"{root}/out", checkpoint=f"{root}/ckpt") == 1
    assert [tuple(r) for r in staging.read_staged_violations(spark, f"{root}/out").select(
        "vid", "house_number", "street_name", "county", "issue_date").collect()] == [(1, "14", "MAIN ST", "MN", "06/25/2016")]
    # a file of another order stops the stream; nothing lands in wrong columns
    write_csv(f"{root}/in/b.csv", "Summons Number,Violation County,Issue Date,House Number,Street Name\n2,MN,06/25/2016,14,MAIN ST\n")
    with pytest.raises(ValueError, match="one header"):
        ingest_violation_csvs(spark, f"{root}/in", f"{root}/out", checkpoint=f"{root}/ckpt")
    with pytest.raises(Exception):
        ingest_violation_csvs(spark, f"{root}/in", f"{root}/out", HEAD.strip().split(","), checkpoint=f"{root}/ckpt")
    assert staging.read_staged_violations(spark, f"{root}/out").count() == 1


def test_batches_are_counted_beyond_the_progress_history(spark):
    root = tempfile.mkdtemp(prefix="curbline-stream-")
    for i in range(7):
        write_csv(f"{root}/in/{i}.csv", HEAD + f"MN,{i},06/25/2016,14,MAIN ST\n")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        for multi_line, want in ((True, 7), (False, 0)):
            assert ingest_violation_csvs(spark, f"{root}/in", f"{root}/out", checkpoint=f"{root}/ckpt",
                                         max_files_per_trigger=1, multi_line=multi_line) == want
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert staging.read_staged_violations(spark, f"{root}/out").count() == 7
