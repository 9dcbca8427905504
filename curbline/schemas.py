"""Explicit schemas: no inference pass over the input, types fixed up front."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw events ("violations"), as the engine sees them after the scan.
VIOLATION = T.StructType([
    T.StructField("vid", T.LongType()),
    T.StructField("house_number", T.StringType()),
    T.StructField("street_name", T.StringType()),
    T.StructField("county", T.StringType()),
    T.StructField("issue_date", T.StringType()),
])

# Raw street segments ("centerline").
SEGMENT = T.StructType([
    T.StructField("seg_ord", T.LongType()),
    T.StructField("physical_id", T.LongType()),
    T.StructField("boro_code", T.IntegerType()),
    T.StructField("full_street", T.StringType()),
    T.StructField("st_label", T.StringType()),
    T.StructField("l_low_hn", T.StringType()),
    T.StructField("l_high_hn", T.StringType()),
    T.StructField("r_low_hn", T.StringType()),
    T.StructField("r_high_hn", T.StringType()),
])

# Header names of the source CSV files -> engine column names.
VIOLATION_CSV_COLUMNS = {
    "Summons Number": "vid",
    "House Number": "house_number",
    "Street Name": "street_name",
    "Violation County": "county",
    "Issue Date": "issue_date",
}
# 0-based positions of the used fields in the public event CSV
# layout (for files whose header names differ or are missing).
VIOLATION_CSV_POSITIONS = {
    "vid": 0,
    "issue_date": 4,
    "county": 21,
    "house_number": 23,
    "street_name": 24,
}
SEGMENT_CSV_COLUMNS = {
    "OBJECTID": "seg_ord",
    "PHYSICALID": "physical_id",
    "BOROCODE": "boro_code",
    "FULL_STREE": "full_street",
    "ST_LABEL": "st_label",
    "L_LOW_HN": "l_low_hn",
    "L_HIGH_HN": "l_high_hn",
    "R_LOW_HN": "r_low_hn",
    "R_HIGH_HN": "r_high_hn",
}


def year_columns(years) -> list[str]:
    """Output column names of the yearly counts: y2015, y2016, ..."""
    return [f"y{y}" for y in years]
