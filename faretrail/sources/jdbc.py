"""Warehouse tables over JDBC.

Plain reads, reads split into parallel hash buckets (``MOD`` predicates, one
query per bucket, NULLs in their own bucket) and reads split by value range.
Credentials and URLs always come from the caller; nothing is hard-coded.

Cast zone-aware timestamps back to ``timestamp_ntz`` after a read: the
warehouse contract has no zones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def hash_predicates(hash_expr: str, partitions: int) -> list[str]:
    """One WHERE clause per bucket; together they cover every row exactly once.

    ``hash_expr`` is a numeric SQL expression evaluated by the database: a
    numeric column as is, or the database's own hash of a text column.
    Negative values land in buckets like positive ones; NULLs go to bucket 0.
    """
    if partitions < 1:
        raise ValueError("partitions must be >= 1")
    bucket = f"MOD(MOD({hash_expr}, {partitions}) + {partitions}, {partitions})"
    preds = [f"{bucket} = {i}" for i in range(partitions)]
    preds[0] = f"({preds[0]} OR {hash_expr} IS NULL)"
    return preds


def _ntz(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in df.schema.fields])


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str],
              hash_field: str | None = None, hash_partitions: int = 10,
              range_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None,
              fetch_size: int = 10000) -> DataFrame:
    """Read a warehouse table; filters and pruned columns are pushed to the database."""
    props = dict(properties)
    props.setdefault("fetchsize", str(fetch_size))
    if hash_field:
        df = spark.read.jdbc(url, table, predicates=hash_predicates(hash_field, hash_partitions),
                             properties=props)
    elif range_column:
        df = spark.read.jdbc(url, table, column=range_column, lowerBound=lower_bound,
                             upperBound=upper_bound, numPartitions=num_partitions,
                             properties=props)
    else:
        df = spark.read.jdbc(url, table, properties=props)
    return _ntz(df)
