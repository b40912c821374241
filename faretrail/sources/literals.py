"""Literal dimension tables.

Built as SQL ``VALUES`` relations: a local relation carries exact size
statistics, so the optimizer knows these few rows are safe to broadcast
(a DataFrame built from a Python list has no statistics and never is).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed values of the warehouse contract: payment types.
PAYMENT_TYPES = [
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]

# Fixed values of the warehouse contract: rate codes (key stored as text).
RATE_CODES = [
    (1, "Standard rate"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated fare"),
    (6, "Group ride"),
]

# Fixed values of the warehouse contract: vendors.
VENDORS = [
    (1, "Creative Mobile Technologies"),
    (2, "VeriFone Inc."),
]


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def values_table(spark: SparkSession, rows: list[tuple[int, str]],
                 key: str, key_type: str, name: str) -> DataFrame:
    body = ", ".join(f"({k}, {_quote(v)})" for k, v in rows)
    return spark.sql(
        f"SELECT CAST(k AS {key_type}) AS {key}, CAST(v AS STRING) AS {name} "
        f"FROM VALUES {body} AS t(k, v)")


def payment_type_dim(spark: SparkSession) -> DataFrame:
    return values_table(spark, PAYMENT_TYPES, "payment_type", "INT", "payment_type_name")


def rate_code_dim(spark: SparkSession) -> DataFrame:
    return values_table(spark, RATE_CODES, "RatecodeID", "STRING", "RatecodeName")


def vendor_dim(spark: SparkSession) -> DataFrame:
    return values_table(spark, VENDORS, "VendorID", "INT", "VendorName")
