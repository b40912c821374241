"""Trip lens: typed trip records derived from the driver's ``lineitem`` and ``orders``.

The driver's tables hold no taxi trips, so every query reads trips through one
mapping.  The same SQL text runs in Spark (tables bound as DataFrame
parameters, no global views) and in DuckDB (the oracle), so both sides start
from identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faretrail.schemas import TRIP_COLUMNS

# Unique per lens row; the order behind the dense trip id.
NATURAL_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
NATURAL_KEY_TYPES = {
    "l_orderkey": "long", "l_linenumber": "int", "l_partkey": "long",
    "l_suppkey": "long", "l_extendedprice": "double",
}

# Fixed mapping (shared with the oracle): lineitem JOIN orders -> trip columns.
# Both inputs are fact-sized at scale, so the join is a shuffle sort-merge join
# on the order key (the hint also gives the join output full parallelism where
# a small ``orders`` would otherwise be broadcast into a one-task scan).  DuckDB
# reads the hint as a comment.
LENS_SQL = """
SELECT /*+ MERGE(orders) */ l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
  CAST(l_suppkey % 3 AS INT) AS VendorID,
  o_orderdate AS tpep_pickup_datetime,
  l_shipdate AS tpep_dropoff_datetime,
  CAST(l_linenumber AS INT) AS passenger_count,
  l_quantity AS trip_distance,
  CAST(-74 AS DOUBLE) + CAST(l_partkey % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS pickup_longitude,
  CAST(40 AS DOUBLE) + CAST(l_suppkey % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS pickup_latitude,
  CAST(l_linenumber AS INT) AS RatecodeID,
  CAST(-73 AS DOUBLE) - CAST(l_partkey % 500 AS DOUBLE) / CAST(1000 AS DOUBLE) AS dropoff_longitude,
  CAST(41 AS DOUBLE) - CAST(l_suppkey % 500 AS DOUBLE) / CAST(1000 AS DOUBLE) AS dropoff_latitude,
  CAST(substr(o_orderpriority, 1, 1) AS INT) AS payment_type,
  l_extendedprice AS fare_amount,
  l_discount AS extra,
  l_tax AS mta_tax,
  l_quantity / CAST(8 AS DOUBLE) AS tip_amount,
  CAST(l_linenumber AS DOUBLE) / CAST(2 AS DOUBLE) AS tolls_amount,
  CAST(0.3 AS DOUBLE) AS improvement_surcharge,
  o_totalprice AS total_amount
FROM {lineitem} AS lineitem JOIN {orders} AS orders ON l_orderkey = o_orderkey
"""


def lens_sql(lineitem: str = "lineitem", orders: str = "orders") -> str:
    """The lens as plain SQL over named tables (for DuckDB / SQL users)."""
    return LENS_SQL.format(lineitem=lineitem, orders=orders)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trip_lens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed trips (natural key + 18 contract columns)."""
    return spark.sql(LENS_SQL, lineitem=table(spark, sf_dir, "lineitem"),
                     orders=table(spark, sf_dir, "orders"))


def as_landing_text(df: DataFrame) -> DataFrame:
    """All-string landing form of typed trips: contract columns as text
    (zone-less timestamps as ``yyyy-MM-dd HH:mm:ss``, independent of the
    session time zone); other columns keep their type."""
    out = []
    for f in df.schema.fields:
        if f.name in TRIP_COLUMNS:
            out.append(F.col(f.name).cast("string").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def raw_trip_lens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips as they land: every contract column text."""
    return as_landing_text(trip_lens(spark, sf_dir))
