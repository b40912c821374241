"""Equi-joins with a chosen physical strategy.

- ``auto`` -- no hint: Catalyst and AQE choose from statistics.  A literal dimension carries
  its exact size and is broadcast by that; anything else only under Spark's byte threshold.
- ``merge`` -- shuffle sort-merge join.
- ``shuffle_hash`` -- shuffle hash join.

Building a plan runs no job, no session setting is changed, and no side is broadcast by a
hint but through :func:`broadcast_bounded`, which takes the side's counted rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The most that a side marked for broadcast may take in memory.
BROADCAST_BYTES = 64 << 20
#: Of a row in a broadcast hash table: null bits, length, pointer and key slot, rounded up.
_ROW_BYTES = 64
_FIXED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
STRATEGIES = ("auto", "merge", "shuffle_hash")
SALT = "_join_salt"


def _hinted(df: DataFrame, strategy: str) -> DataFrame:
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    return df if strategy == "auto" else df.hint(strategy)


def join(left: DataFrame, right: DataFrame, on: str | list[str] | Column,
         how: str = "inner", strategy: str = "auto") -> DataFrame:
    return left.join(_hinted(right, strategy), on, how)


def broadcast_bounded(df: DataFrame, rows: int | None, max_bytes: int = BROADCAST_BYTES) -> DataFrame | None:
    """``df`` marked for broadcast if its ``rows``, which the caller has counted, are proven to
    take at most ``max_bytes``: every column of fixed width, eight bytes each.  Else None."""
    fixed = all(isinstance(f.dataType, _FIXED) and not (isinstance(f.dataType, T.DecimalType) and f.dataType.precision > 18)
                for f in df.schema.fields)
    if rows is None or not fixed or rows * (8 * len(df.schema.fields) + _ROW_BYTES) > max_bytes:
        return None
    return F.broadcast(df)


def salted_join(left: DataFrame, right: DataFrame, on: str, strategy: str = "merge",
                salts: int = 32) -> DataFrame:
    """Inner join of a large ``left`` to a small ``right`` on few key values.

    Every left row takes a salt from its own content and every right row stands once per
    salt, so the rows of one key meet in ``salts`` tasks, with or without AQE.
    """
    salt = F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int")
    spread = right.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.withColumn(SALT, salt).join(_hinted(spread, strategy), [on, SALT]).drop(SALT)


def join_on(left: DataFrame, right: DataFrame, left_keys: list[str],
            right_keys: list[str], how: str = "inner", strategy: str = "auto") -> DataFrame:
    """Join on differently named key paths; both key columns are kept."""
    if len(left_keys) != len(right_keys):
        raise ValueError("key lists differ in length")
    cond = None
    for lk, rk in zip(left_keys, right_keys):
        term = left[lk] == right[rk]
        cond = term if cond is None else cond & term
    return join(left, right, cond, how, strategy)
