"""CSV scan/sink round trips and Parquet staging."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from given_tables import SF001
from curbline.plans import job, reports
from curbline.sources import csv as csv_io
from curbline.sources import fixtures, staging


def _tmp():
    return tempfile.mkdtemp(prefix="curbline-test-")


def test_csv_quotes_newlines_and_empty(spark):
    d = _tmp()
    path = os.path.join(d, "v.csv")
    with open(path, "w") as fh:
        fh.write('Summons Number,Plate ID,Issue Date,Violation County,House Number,Street Name\n')
        fh.write('1,"AB, 12",06/25/2015,QNS,12-34,"MAIN ST"\n')
        fh.write('2,"multi\nline",07/01/2016,K,"7A","SAY ""HI"" AVE"\n')
        fh.write('3,X,01/02/2017,BX,"",ELM ST\n')
    df = csv_io.read_violations_csv(spark, path)
    rows = sorted(df.collect())
    assert [r["vid"] for r in rows] == [1, 2, 3]
    assert rows[1]["street_name"] == 'SAY "HI" AVE' and rows[1]["house_number"] == "7A"
    assert rows[2]["house_number"] is None          # quoted empty field reads as NULL
    assert df.columns == ["vid", "house_number", "street_name", "county", "issue_date"]


def test_segments_csv_without_order_column_gets_file_order(spark):
    d = _tmp()
    path = os.path.join(d, "s.csv")
    with open(path, "w") as fh:
        fh.write("PHYSICALID,L_LOW_HN,L_HIGH_HN,R_LOW_HN,R_HIGH_HN,FULL_STREE,ST_LABEL,BOROCODE\n")
        fh.write("7,1,9,2,10,MAIN ST,MAIN,1\n8,11,19,12,20,MAIN ST,MAIN,1\n")
    rows = csv_io.read_segments_csv(spark, path).orderBy("seg_ord").collect()
    assert [r["physical_id"] for r in rows] == [7, 8]
    assert rows[0]["boro_code"] == 1


def test_report_sink_errorifexists_and_overwrite(spark):
    v, s = fixtures.violations(spark, SF001), fixtures.segments(spark, SF001)
    rep = reports.trend_report(v, s, fixtures.FIXTURE_YEARS)
    path = os.path.join(_tmp(), "out")
    csv_io.write_report_csv(rep, path)
    with pytest.raises(Exception):
        csv_io.write_report_csv(rep, path)
    back = csv_io.read_report_csv(spark, path, fixtures.FIXTURE_YEARS)
    assert sorted(back.collect()) == sorted(rep.collect())
    r3 = reports.trend_report_r3(v, s, fixtures.FIXTURE_YEARS)
    csv_io.write_report_csv(r3, path, mode="overwrite")
    back = csv_io.read_report_csv(spark, path, fixtures.FIXTURE_YEARS)
    assert sorted(back.collect()) == sorted(r3.collect())


def test_staging_prunes_years(spark):
    v = fixtures.violations(spark, SF001)
    path = os.path.join(_tmp(), "staged")
    staging.stage_violations(v, path)
    back = staging.read_staged_violations(spark, path, (1995, 1996))
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "issue_year" in plan
    want = v.where(F.get(F.split("issue_date", "/"), F.lit(2)).cast("int").between(1995, 1996))
    assert sorted(back.collect()) == sorted(want.collect())
    assert sorted(back.columns) == sorted(v.columns)


def test_command_line_job(spark):
    from curbline.plans import job
    v, s = fixtures.violations(spark, SF001), fixtures.segments(spark, SF001)
    root = _tmp()
    vdir, sdir = os.path.join(root, "v"), os.path.join(root, "s")
    csv_io.write_violations_csv(v, vdir)
    csv_io.write_segments_csv(s, sdir)
    out = os.path.join(root, "report")
    assert job.main([out, "--violations", vdir, "--segments", sdir, "--years", "1995-1999"]) == 0
    back = csv_io.read_report_csv(spark, out, fixtures.FIXTURE_YEARS)
    want = reports.trend_report(v, s, fixtures.FIXTURE_YEARS)
    assert sorted(back.collect()) == sorted(want.collect())
    # staged events, matched-only variant
    staged = staging.stage_violations(v, os.path.join(root, "staged"))
    out2 = os.path.join(root, "report2")
    job.main([out2, "--violations", staged, "--segments", sdir, "--years", "1995-1999",
              "--staged", "--report", "matched"])
    back2 = csv_io.read_report_csv(spark, out2, fixtures.FIXTURE_YEARS)
    want2 = reports.trend_matched_segments(v, s, fixtures.FIXTURE_YEARS)
    assert sorted(back2.collect()) == sorted(want2.collect())


def test_read_by_position(spark):
    d = _tmp()
    path = os.path.join(d, "p.csv")
    header = ",".join(f"col{i}" for i in range(30))
    def row(vid, date, county, house, street):
        vals = [f"x{i}" for i in range(30)]
        vals[0], vals[4], vals[21], vals[23], vals[24] = str(vid), date, county, house, street
        return ",".join(vals)
    with open(path, "w") as fh:
        fh.write(header + "\n")
        fh.write(row(7, "06/25/2015", "QNS", "12-34", "MAIN ST") + "\n")
        fh.write(row(8, "07/01/2016", "K", "7A", "ELM ST") + "\n")
    df = csv_io.read_violations_csv(spark, path, by_position=True)
    assert df.columns == ["vid", "house_number", "street_name", "county", "issue_date"]
    assert sorted(tuple(r) for r in df.collect()) == [
        (7, "12-34", "MAIN ST", "QNS", "06/25/2015"), (8, "7A", "ELM ST", "K", "07/01/2016")]


def test_csv_scan_reads_only_used_columns(spark):
    d = _tmp()
    path = os.path.join(d, "wide.csv")
    cols = ["Summons Number", "Plate ID", "Registration State", "Plate Type", "Issue Date"] + \
        [f"Extra {i}" for i in range(16)] + ["Violation County", "Front Of", "House Number",
                                              "Street Name", "More"]
    with open(path, "w") as fh:
        fh.write(",".join(f'"{c}"' for c in cols) + "\n")
        fh.write(",".join(["1", "P", "NY", "PAS", "06/25/2015"] + ["x"] * 16
                          + ["QNS", "F", "12-34", "MAIN ST", "m"]) + "\n")
    df = csv_io.read_violations_csv(spark, path)
    plan = df._jdf.queryExecution().executedPlan().toString()
    schema = plan[plan.index("ReadSchema: "):].split("\n")[0]
    assert "Summons Number" in schema and "Plate" not in schema and "Extra" not in schema
    assert df.collect()[0]["street_name"] == "MAIN ST"


def test_command_line_counts_with_checkpoint(spark):
    from pyspark.sql import types as T

    from curbline.plans import job
    v, s = fixtures.violations(spark, SF001), fixtures.segments(spark, SF001)
    root = _tmp()
    vdir, sdir = os.path.join(root, "v"), os.path.join(root, "s")
    csv_io.write_violations_csv(v, vdir)
    csv_io.write_segments_csv(s, sdir)
    out = os.path.join(root, "counts")
    assert job.main([out, "--violations", vdir, "--segments", sdir, "--report", "counts",
                     "--checkpoint", "--single-line"]) == 0
    schema = T.StructType([T.StructField("physical_id", T.LongType()),
                           T.StructField("year", T.IntegerType()),
                           T.StructField("cnt", T.LongType())])
    back = spark.read.schema(schema).csv(out)
    want = reports.count_id_year(v, s)
    assert sorted(back.collect()) == sorted(want.collect())


def write_csv(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


A = "Summons Number,Plate ID,House Number,Street Name,Violation County,Issue Date\n"
B = "Issue Date,Violation County,Street Name,House Number,Summons Number\n"


def test_mixed_column_orders_and_extra_columns(spark):
    root = tempfile.mkdtemp(prefix="curbline-mixed-")
    write_csv(f"{root}/2015/a.csv", A + '1,X,14,"MAIN, ST",MN,06/25/2015\n')
    write_csv(f"{root}/2016/b.csv", B + "06/25/2016,MN,MAIN ST,16,2\n")
    write_csv(f"{root}/2017/empty.csv", "")
    want = [(1, "14", "MAIN, ST", "MN", "06/25/2015"), (2, "16", "MAIN ST", "MN", "06/25/2016")]
    for multi_line in (True, False):
        got = csv_io.read_violations_csv(spark, root, multi_line=multi_line).collect()
        assert sorted(tuple(r) for r in got) == want
    write_csv(f"{root}/2018/c.csv", "Summons Number,House Number\n3,1\n")
    with pytest.raises(ValueError, match="Street Name"):
        csv_io.read_violations_csv(spark, root)


def test_segment_order_over_several_files(spark):
    root = tempfile.mkdtemp(prefix="curbline-order-")
    head = "PHYSICALID,BOROCODE,FULL_STREE,ST_LABEL,L_LOW_HN,L_HIGH_HN,R_LOW_HN,R_HIGH_HN\n"
    line = "{},1,A ST,A ST,1,9,2,10\n"
    write_csv(f"{root}/a.csv", head + "".join(line.format(i) for i in range(3)))
    write_csv(f"{root}/b.csv", head + "".join(line.format(i) for i in range(3, 3000)))      # the larger file
    write_csv(f"{root}/c.csv", head + line.format(3000))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        for multi_line in (True, False):
            rows = csv_io.read_segments_csv(spark, root, multi_line=multi_line).collect()
            assert sorted((r.seg_ord, r.physical_id) for r in rows) == [(i, i) for i in range(3001)]
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_staging_writes_few_files(spark):
    v = fixtures.violations(spark, SF001).repartition(64)
    path = staging.stage_violations(v, tempfile.mkdtemp(prefix="curbline-stage-") + "/t")
    files = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    years = v.selectExpr("get(split(issue_date, '/'), 2) AS y").distinct().count()
    assert len(files) <= 2 * years + 2
    assert staging.read_staged_violations(spark, path).count() == v.count()


def test_counts_job_keeps_to_the_years_given(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="curbline-job-")
    csv_io.write_violations_csv(fixtures.violations(spark, SF001), f"{root}/v")
    csv_io.write_segments_csv(fixtures.segments(spark, SF001), f"{root}/s")

    def years(*more):
        out = f"{root}/out{len(os.listdir(root))}"
        assert job.main([out, "--violations", f"{root}/v", "--segments", f"{root}/s", "--report", "counts", *more]) == 0
        return {r[1] for r in spark.read.csv(out).collect()}

    assert years("--years", "1995-1995") == {"1995"}
    assert len(years()) > 1


def test_job_options_reach_the_report(spark):
    args = job.build_parser().parse_args(["o", "--violations", "v", "--segments", "s", "--salt", "auto", "--strategy", "preaggregate",
                                          "--broadcast", "no", "--input-bytes", str(10 ** 14), "--cores", "8000"])
    assert (args.salt, args.strategy, args.broadcast) == ("auto", "preaggregate", "no")
    assert int(job.settings(args)["spark.sql.shuffle.partitions"]) > 18_000
    few = job.settings(job.build_parser().parse_args(["o", "--violations", "v", "--segments", "s"]))
    assert few["spark.sql.codegen.hugeMethodLimit"] == "8000" and "spark.sql.shuffle.partitions" not in few
