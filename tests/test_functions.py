"""Column functions: parsing table, recoding, years, slope and rounding."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from curbline.functions import (
    alias_map, borough_code, number_part, ols_slope, parity, parse_int,
    recode_county, rounded, strip_letters, whole_number, year_parsed, year_text,
)

# The 20 report rows published with the reference job
# (id, counts 2015..2019, slope rounded to one digit).
GOLDEN = [
    (3, 824, 590, 752, 839, 345, -70.9),
    (5, 1364, 1402, 1808, 2174, 928, -10.0),
    (6, 2034, 1581, 1625, 1776, 672, -252.9),
    (23, 9, 5, 163, 83, 314, 68.8),
    (24, 256, 748, 1812, 3028, 808, 338.4),
    (25, 2, 0, 0, 1, 0, -0.3),
    (45, 12, 9, 42, 21, 3, -0.6),
    (46, 524, 427, 619, 669, 261, -28.4),
    (47, 894, 1422, 1867, 1737, 540, -39.3),
    (48, 2181, 1381, 1730, 1135, 342, -392.4),
    (49, 1536, 1154, 1186, 1003, 588, -204.7),
    (50, 11531, 9845, 10399, 8243, 2397, -1987.0),
    (51, 633, 550, 770, 477, 127, -108.5),
    (52, 3213, 3285, 3753, 2910, 1170, -446.1),
    (53, 81, 79, 93, 27, 21, -17.2),
    (56, 979, 1019, 782, 1266, 687, -33.7),
    (58, 3, 7, 9, 78, 60, 18.5),
    (59, 11, 36, 97, 60, 30, 6.2),
    (60, 162, 114, 100, 94, 37, -27.0),
    (61, 3, 0, 3, 0, 0, -0.6),
]
YEARS = (2015, 2016, 2017, 2018, 2019)


def test_golden_slopes(spark):
    cols = ["id", "a", "b", "c", "d", "e", "expected"]
    df = spark.createDataFrame(GOLDEN, cols)
    out = df.select("id", "expected",
                    rounded(ols_slope(["a", "b", "c", "d", "e"], YEARS), 7).alias("s")).collect()
    for r in out:
        assert r["s"] == pytest.approx(r["expected"], abs=1e-9), r


def test_slope_equals_least_squares(spark):
    rng = np.random.default_rng(7)
    ys = rng.integers(0, 10_000, size=(50, 6)).tolist()
    xs = (1990, 1992, 1995, 1996, 2001, 2004)           # uneven spacing
    df = spark.createDataFrame(ys, [f"c{i}" for i in range(6)])
    got = [r[0] for r in df.select(ols_slope([f"c{i}" for i in range(6)], xs)).collect()]
    for y, g in zip(ys, got):
        want = np.polyfit(np.array(xs, float), np.array(y, float), 1)[0]
        assert g == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_regr_slope_agrees(spark):
    rows = [(i, y, c) for i, g in enumerate(GOLDEN) for y, c in zip(YEARS, g[1:6])]
    df = spark.createDataFrame(rows, ["id", "year", "cnt"])
    got = {r["id"]: r["s"] for r in df.groupBy("id").agg(
        F.round(F.regr_slope("cnt", "year"), 7).alias("s")).collect()}
    for i, g in enumerate(GOLDEN):
        assert got[i] == pytest.approx(g[6], abs=1e-9)


def test_round_half_up(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (0.15,), (-0.3,)], ["x"])
    out = [tuple(r) for r in df.select(rounded(F.col("x"), 0), rounded(F.col("x"), 1)).collect()]
    assert out == [(3.0, 2.5), (-3.0, -2.5), (0.0, 0.2), (-0.0, -0.3)] or \
        [(a, b) for a, b in out] == [(3.0, 2.5), (-3.0, -2.5), (0.0, 0.2), (0.0, -0.3)]


# house-number parsing table: input -> (n1, n2)
HOUSES = [
    ("12", 12, None), ("12A", 12, None), ("12-34", 12, 34), ("1-2-3", 1, 2),
    ("-7", None, 7), ("12b", None, None), ("N/A", None, None), ("12 1/2", None, None),
    ("12.5", 12, None), ("99999999999", None, None), ("", None, None),
    (" 12 ", 12, None), ("0", 0, None), ("12-", 12, None), ("40-01", 40, 1),
    (None, None, None),
]


def test_house_parsing_table(spark):
    df = spark.createDataFrame([(h,) for h, _, _ in HOUSES], "h string")
    h = strip_letters("h")
    got = df.select(number_part(h, 0), number_part(h, 1)).collect()
    for (raw, n1, n2), row in zip(HOUSES, got):
        assert (row[0], row[1]) == (n1, n2), raw


def test_number_part_equals_split(spark):
    vals = ["12", "12-34", "1-2-3", "-7", "12-", "--", "-", "a-b", "7--9", "", None, "3-4-5-6"]
    df = spark.createDataFrame([(v,) for v in vals], "h string")
    for i in (0, 1):
        fast = df.select(number_part("h", i)).collect()
        ref = df.select(F.get(F.split("h", "-"), F.lit(i)).try_cast("int")).collect()
        assert fast == ref


def test_strip_letters_upper_only(spark):
    df = spark.createDataFrame([("12AZ",), ("12b",), ("A-1B",)], "h string")
    assert [r[0] for r in df.select(strip_letters("h")).collect()] == ["12", "12b", "-1"]


def test_whole_number(spark):
    df = spark.createDataFrame([("12",), ("12-34",), ("x",)], "h string")
    assert [r[0] for r in df.select(whole_number("h")).collect()] == [12, None, None]


def test_parse_int_cuts_decimals_and_refuses_the_rest(spark):
    """Values of Spark 2.4's string to int cast (spaces apart)."""
    values = [("12.5", 12), ("12.", 12), (".5", 0), (".", 0), ("+7", 7), ("-7", -7), ("-7.9", -7), ("+.5", 0), ("0012", 12),
              (" 12 ", 12), ("", None), ("-", None), ("+", None), ("1e2", None), ("1_000", None), ("12.5.1", None), ("12-5", None),
              ("1 2", None), ("0x1F", None), ("2147483647", 2147483647), ("2147483648", None), ("-2147483648", -2147483648),
              ("5-", None), ("5+", None), ("--5", None), ("12.x", None), ("NaN", None), (None, None)]
    df = spark.createDataFrame([(v,) for v, _ in values], "h string")
    assert [r[0] for r in df.select(parse_int("h")).collect()] == [n for _, n in values]
    con = duckdb.connect()
    from curbline.plans.oracle import strict_int
    sql = strict_int("h")
    assert [con.execute(f"SELECT {sql} FROM (SELECT ? AS h)", [v]).fetchall()[0][0] for v, _ in values] == [n for _, n in values]


def test_parity_uses_second_part(spark):
    df = spark.createDataFrame([(12, None), (12, 35), (13, 34)], "a int, b int")
    assert [r[0] for r in df.select(parity("a", "b")).collect()] == [0, 1, 0]


def test_alias_tables():
    full = alias_map("final")
    assert len(full) == 21 and full["ST"] == "5" and full["PBX"] == "2"
    assert "ST" not in alias_map("no_st") and len(alias_map("no_st")) == 20
    assert "PBX" not in alias_map("no_pbx") and len(alias_map("no_pbx")) == 20


def test_recode_county(spark):
    vals = ["MAN", "NEW Y", "PBX", "ST", "ZZ", "1", None, "qns"]
    df = spark.createDataFrame([(v,) for v in vals], "c string")
    out = df.select(recode_county("c"), borough_code("c"), borough_code("c", "no_st"),
                    borough_code("c", "no_pbx")).collect()
    assert [r[0] for r in out] == ["1", "1", "2", "5", "ZZ", "1", None, "qns"]
    assert [r[1] for r in out] == [1, 1, 2, 5, None, 1, None, None]
    assert out[3][2] is None and out[3][3] == 5      # 'ST' without / with its alias
    assert out[2][3] is None and out[2][2] == 2      # 'PBX'


def test_recode_equals_na_replace(spark):
    vals = list(alias_map("final")) + ["ZZ", "1", "man", "BX "]
    df = spark.createDataFrame([(v,) for v in vals], "c string")
    want = [r[0] for r in df.na.replace(alias_map("final"), subset=["c"]).collect()]
    assert [r[0] for r in df.select(recode_county("c")).collect()] == want


def test_years(spark):
    df = spark.createDataFrame([("06/25/2015",), ("6/5/2015",), ("13/01/2015",), ("2015",),
                                ("06/25/20x5",)], "d string")
    out = df.select(year_text("d"), year_parsed("d")).collect()
    assert [r[0] for r in out] == [2015, 2015, 2015, None, None]
    assert [r[1] for r in out] == [2015, 2015, None, None, None]


def test_scale_settings():
    from curbline.session import scale_settings
    big = scale_settings(100 * 1024 ** 4, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 20480        # 256 MiB each, no cap
    huge = scale_settings(1000 * 1024 ** 4, 8000)
    assert int(huge["spark.sql.shuffle.partitions"]) == 204800
    small = scale_settings(10 * 1024 ** 2, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_submit_settings():
    from curbline.session import submit_settings
    s = submit_settings()
    assert s["spark.storage.decommission.shuffleBlocks.enabled"] == "true"
    assert int(s["spark.task.maxFailures"]) > 4
