"""Column contracts of the trip warehouse.

One ordered name -> type map drives the landing schema (every column text),
the typed frame, the fact table and every dimension.  Names are the
warehouse contract, including the ``dropff_location_id`` spelling.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Landing columns and the type each one is coerced to (fixed contract).
TRIP_COLUMNS: dict[str, str] = {
    "VendorID": "int",
    "tpep_pickup_datetime": "timestamp",
    "tpep_dropoff_datetime": "timestamp",
    "passenger_count": "int",
    "trip_distance": "double",
    "pickup_longitude": "double",
    "pickup_latitude": "double",
    "RatecodeID": "int",
    "dropoff_longitude": "double",
    "dropoff_latitude": "double",
    "payment_type": "int",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "improvement_surcharge": "double",
    "total_amount": "double",
}

TRIP_ID = "trip_id"
PICKUP_ID = "pickup_location_id"
DROPOFF_ID = "dropff_location_id"

# Fact table, in load order (fixed contract).
FACT_COLUMNS: list[str] = [
    "trip_id", "VendorID", "passenger_count", "tpep_pickup_datetime",
    "tpep_dropoff_datetime", "trip_distance", "RatecodeID", "payment_type",
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "pickup_location_id",
    "dropff_location_id",
]

PICKUP_DIM_COLUMNS = ["pickup_location_id", "pickup_longitude", "pickup_latitude"]
DROPOFF_DIM_COLUMNS = ["dropff_location_id", "dropoff_longitude", "dropoff_latitude"]
DATE_DIM_COLUMNS = ["datekey", "date", "year_yy", "year_yyyy", "month"]

# Analysis table of the three-way location join (fixed contract).
ANALYSIS_COLUMNS = [
    "trip_id", "vendorid", "trip_distance", "tpep_pickup_datetime",
    "tpep_dropoff_datetime", "pickup_location_id", "pickup_longitude",
    "pickup_latitude", "dropff_location_id", "dropoff_longitude",
    "dropoff_latitude",
]

# Same fields in the order the path-list variant of the analysis selects them.
ANALYSIS_FIELD_PATHS = [
    "trip_id", "vendorid", "trip_distance", "tpep_pickup_datetime",
    "pickup_location_id", "pickup_longitude", "pickup_latitude",
    "tpep_dropoff_datetime", "dropff_location_id", "dropoff_longitude",
    "dropoff_latitude",
]

_SPARK_TYPES = {
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp": T.TimestampNTZType(),
    "date": T.DateType(),
}


def resolve_column(columns: list[str], name: str) -> str:
    """The frame's own spelling of ``name`` (matched case-insensitively), so a
    reference like ``vendorid`` works whatever ``spark.sql.caseSensitive`` is."""
    if name in columns:
        return name
    for c in columns:
        if c.lower() == name.lower():
            return c
    return name


def spark_type(name: str) -> T.DataType:
    return _SPARK_TYPES[name]


def raw_schema(extra: dict[str, str] | None = None) -> T.StructType:
    """Landing schema: every trip column as text, plus typed pass-through columns."""
    fields = [T.StructField(c, T.StringType(), True) for c in TRIP_COLUMNS]
    for name, typ in (extra or {}).items():
        fields.append(T.StructField(name, spark_type(typ), True))
    return T.StructType(fields)
