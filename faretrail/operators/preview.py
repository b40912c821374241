"""Previews and partition statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def preview(df: DataFrame, n: int = 20, order_by: str = "trip_id") -> DataFrame:
    """First ``n`` rows in a stable order (a top-n: each task keeps n rows,
    the driver merges at most n per task)."""
    return df.orderBy(F.col(order_by).asc_nulls_last()).limit(n)


def print_preview(df: DataFrame, n: int = 2, order_by: str | None = None) -> None:
    """Console check of a frame: its schema, then ``n`` untruncated rows
    (only ``n`` rows reach the driver)."""
    df.printSchema()
    (preview(df, n, order_by) if order_by else df.limit(n)).show(n, truncate=False)


def dealt(df: DataFrame, parts: int, by: Column) -> DataFrame:
    """``df`` in exactly ``parts`` partitions: a row goes to that of ``by`` (whole numbers) modulo
    ``parts``, so dense ids are dealt evenly."""
    return df.repartitionById(parts, F.pmod(by, F.lit(parts)).cast("int"))


def partition_stats(df: DataFrame) -> DataFrame:
    """Number of the frame's partitions that hold rows, total rows, and the largest partition."""
    per_part = df.groupBy(F.spark_partition_id().alias("pid")).agg(F.count(F.lit(1)).alias("rows"))
    return per_part.agg(
        F.count(F.lit(1)).alias("partitions"),
        F.sum("rows").alias("rows"),
        F.max("rows").alias("largest_partition_rows"),
    )
