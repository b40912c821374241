"""Grouped and global counts.

Every count here is a partial + final hash aggregate: rows are combined
map-side before the shuffle, so a group key holding a third of all rows
ships one partial row per task, not the rows themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faretrail.schemas import resolve_column


def grouped_count(df: DataFrame, key: str, key_alias: str | None = None,
                  count_alias: str = "count") -> DataFrame:
    """Rows per key value; NULL is a group of its own.  The key is resolved
    case-insensitively (``vendorid`` finds ``VendorID``) and output under
    ``key_alias``."""
    return df.groupBy(F.col(resolve_column(df.columns, key)).alias(key_alias or key)).agg(
        F.count(F.lit(1)).alias(count_alias))


def grouped_count_sql(df: DataFrame, key: str, count_alias: str = "count") -> DataFrame:
    """Same count through Spark SQL over the frame (bound as a parameter,
    no session-global view)."""
    name = "`" + key.replace("`", "``") + "`"
    alias = "`" + count_alias.replace("`", "``") + "`"
    return df.sparkSession.sql(
        f"SELECT {name}, count(*) AS {alias} FROM {{trips}} GROUP BY {name}", trips=df)


def row_count(df: DataFrame, alias: str = "n") -> DataFrame:
    """Global row count as a one-row frame (lazy; no action on the driver)."""
    return df.agg(F.count(F.lit(1)).alias(alias))
