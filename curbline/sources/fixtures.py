"""Event and segment tables derived from the driver's TPC-H-like tables.

The driver only ships ``orders`` and ``part`` (and others not needed here),
so ``violations`` are derived from ``orders`` and ``segments`` from ``part``
with deterministic rules that reproduce the messy shapes of real data:
compound and lettered house numbers, 'N/A', lower-case letters, NULLs, every
county alias plus an unknown one, two spellings of a street, NULL bounds.
The same rules exist as DuckDB SQL in ``curbline.plans.oracle``.
The derivation is a narrow projection: it scales with the source tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Fixture years (the orders table spans 1995-2001, so the filter is exercised).
FIXTURE_YEARS = (1995, 1996, 1997, 1998, 1999)

_VIOLATION_EXPRS = [
    "o_orderkey AS vid",
    """CASE WHEN o_orderkey % 97 = 0 THEN NULL
         WHEN o_orderkey % 89 = 0 THEN 'N/A'
         WHEN o_orderkey % 83 = 0 THEN '12b'
         WHEN o_orderkey % 71 = 0 THEN concat(CAST(o_custkey % 60 + 1 AS STRING), '.5')
         WHEN o_orderkey % 67 = 0 THEN '1e1'
         WHEN o_orderkey % 79 = 0 THEN concat(CAST(o_custkey % 60 + 1 AS STRING), '-',
              CAST((o_orderkey + o_custkey) % 40 + 1 AS STRING), '-9')
         WHEN o_orderkey % 7 < 3 THEN concat(CAST(o_custkey % 60 + 1 AS STRING), '-',
              CAST((o_orderkey + o_custkey) % 40 + 1 AS STRING))
         WHEN o_orderkey % 7 = 3 THEN concat(CAST(o_custkey % 60 + 1 AS STRING), 'A')
         ELSE CAST(o_custkey % 60 + 1 AS STRING) END AS house_number""",
    """concat(CASE WHEN o_orderkey % 2 = 0 THEN 'Main St ' ELSE 'main street ' END,
              CAST(o_orderkey % 11 AS STRING)) AS street_name""",
    # the 23 county spellings, chosen by o_orderkey % 23 (same values, in the
    # same order, as the CASE of the DuckDB text; an array index is compact code)
    """element_at(array('MAN', 'MH', 'MN', 'NEWY', 'NEW Y', 'NY', 'BRONX', 'BX', 'PBX',
      'BK', 'K', 'KING', 'KINGS', 'Q', 'QN', 'QNS', 'QU', 'QUEEN', 'R', 'RICHMOND', 'ST',
      'ZZ', '1'), CAST(o_orderkey % 23 AS INT) + 1) AS county""",
    "date_format(o_orderdate, 'MM/dd/yyyy') AS issue_date",
]

_SEGMENT_EXPRS = [
    "p_partkey AS seg_ord",
    "CAST(floor(p_partkey / 2) AS BIGINT) AS physical_id",
    "CAST(p_partkey % 5 + 1 AS INT) AS boro_code",
    "concat('Main St ', CAST(p_partkey % 11 AS STRING)) AS full_street",
    """CASE WHEN p_partkey % 3 = 0 THEN concat('main st ', CAST(p_partkey % 11 AS STRING))
         ELSE concat('Main Street ', CAST((p_partkey + 4) % 11 AS STRING)) END AS st_label""",
    """CASE WHEN CAST(floor(p_partkey / 2) AS BIGINT) % 29 = 7 THEN NULL
         WHEN p_partkey % 4 = 0 THEN concat(CAST(p_size AS STRING), '-', CAST(p_size % 20 AS STRING))
         ELSE CAST(p_size AS STRING) END AS l_low_hn""",
    """CASE WHEN p_partkey % 4 = 0 THEN concat(CAST(p_size + 10 AS STRING), '-',
              CAST(p_size % 20 + 15 AS STRING))
         ELSE CAST(p_size + 10 AS STRING) END AS l_high_hn""",
    """CASE WHEN p_partkey % 4 = 0 THEN concat(CAST(p_size + 1 AS STRING), '-',
              CAST(p_size % 20 + 1 AS STRING))
         ELSE CAST(p_size + 1 AS STRING) END AS r_low_hn""",
    """CASE WHEN p_partkey % 4 = 0 THEN concat(CAST(p_size + 12 AS STRING), '-',
              CAST(p_size % 20 + 18 AS STRING))
         ELSE CAST(p_size + 12 AS STRING) END AS r_high_hn""",
]


# Columns of the driver's tables that are read (explicit: no schema-inference job).
SOURCE_SCHEMAS = {
    "orders": T.StructType([T.StructField("o_orderkey", T.LongType()),
                            T.StructField("o_custkey", T.LongType()),
                            T.StructField("o_orderdate", T.TimestampNTZType())]),
    "part": T.StructType([T.StructField("p_partkey", T.LongType()),
                          T.StructField("p_size", T.IntegerType())]),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables, as it is split on disk.

    A file of one row group is one task. A caller who runs on such files (the
    benchmark) may set ``curbline.source.splits``: the rows are then dealt out
    over so many partitions first. Off unless set, whatever the size.
    """
    splits = spark.conf.get("curbline.source.splits", None)
    reader = spark.read
    if name in SOURCE_SCHEMAS:
        reader = reader.schema(SOURCE_SCHEMAS[name])
    rows = reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return rows.repartition(int(splits)) if splits else rows


def violations_from_orders(orders: DataFrame) -> DataFrame:
    """Schema ``curbline.schemas.VIOLATION``."""
    return orders.selectExpr(*_VIOLATION_EXPRS)


def segments_from_part(part: DataFrame) -> DataFrame:
    """Schema ``curbline.schemas.SEGMENT``."""
    return part.selectExpr(*_SEGMENT_EXPRS)


def violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return violations_from_orders(table(spark, sf_dir, "orders"))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments_from_part(table(spark, sf_dir, "part"))
