"""File sinks: Parquet, Hive-style partitioned Parquet, header CSV landing."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faretrail.schemas import TRIP_COLUMNS


#: Tasks that share a folder's rows when AQE is off.
FOLDER_SALTS = 4
#: Rows of a compressed file, which can't be split for reading.
PACKED_ROWS = 500_000


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def with_day_partitions(df: DataFrame, ts_col: str = "tpep_pickup_datetime",
                        names: tuple[str, str, str] = ("year", "month", "date")) -> DataFrame:
    """Add unpadded integer ``year``/``month``/``date`` columns of a timestamp."""
    ts = F.col(ts_col).try_cast("timestamp_ntz") if ts_col else None
    y, m, d = names
    return df.withColumns({y: F.year(ts), m: F.month(ts), d: F.dayofmonth(ts)})


def write_partitioned(df: DataFrame, path: str,
                      partition_cols: tuple[str, ...] = ("year", "month", "date"),
                      mode: str = "errorifexists", fmt: str = "parquet",
                      finish: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Write a ``col=value/...`` layout.

    ``mode='replace_partitions'`` replaces the folders that ``df`` has rows for and leaves all
    others as they are, so a day that is landed again replaces itself alone.  ``finish`` makes the
    rows' final form, row by row, behind the shuffle, which then moves the narrower one.

    ``rebalance`` on the partition columns gathers each folder's rows into few
    tasks (few files per folder instead of one per task and folder), and AQE
    splits a folder that holds a large share of the rows into several
    advisory-size tasks, so a hot day never lands in a single writer.
    """
    cols = list(partition_cols)
    spark = df.sparkSession
    if spark.conf.get("spark.sql.adaptive.enabled") == "true":
        dealt = df.hint("rebalance", *cols)
    else:  # the hint needs AQE; a few salts per folder split a hot one all the same
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(FOLDER_SALTS))
        dealt = df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *cols, salt)
    writer = (finish(dealt) if finish else dealt).write.partitionBy(*cols).format(fmt).option("header", True)
    if mode == "replace_partitions":
        writer, mode = writer.option("partitionOverwriteMode", "dynamic"), "overwrite"
    writer.mode(mode).save(path)


def landing_order(df: DataFrame) -> DataFrame:
    """Contract columns first (schema order), then pass-through columns."""
    first = [c for c in TRIP_COLUMNS if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in TRIP_COLUMNS])


def land_csv(df: DataFrame, path: str, mode: str = "append", compression: str | None = None, own_order: bool = False) -> None:
    """Append header CSV files to a landing folder (new files, unique names),
    columns in landing order so a fixed streaming schema lines up; ``own_order`` leaves them as they
    are, for a reading by header.

    ``compression='gzip'`` writes a quarter of the bytes or less, lightly compressed.  Such a file is read by one task, so
    none has more than :data:`PACKED_ROWS` rows."""
    writer = (df if own_order else landing_order(df)).write.mode(mode).option("header", True)
    if compression:
        writer = (writer.option("compression", compression).option("zlib.compress.level", "BEST_SPEED")
                  .option("maxRecordsPerFile", PACKED_ROWS))
    writer.csv(path)


def stamped_name(at: datetime, prefix: str = "trips") -> str:
    """``trips-2024-5-5-0-1``: year, month, day, hour, minute, unpadded."""
    return f"{prefix}-{at.year}-{at.month}-{at.day}-{at.hour}-{at.minute}"


def land_csv_stamped(df: DataFrame, path: str, at: datetime, prefix: str = "trips") -> str:
    """Land ``df`` as header CSV in the folder of its minute under ``path``; returns the folder.

    One pattern (``path/trips-2024-5-5-0-*``) then reads the drops of an hour.  A drop
    repeated within its minute replaces itself, so a retried landing doubles no rows.
    """
    folder = f"{path.rstrip('/')}/{stamped_name(at, prefix)}"
    land_csv(df, folder, mode="overwrite")
    return folder


def csv_to_parquet(spark, csv_path: str, parquet_path: str, mode: str = "errorifexists") -> None:
    """Convert header CSV to Parquet, every column kept as text.  A file whose header differs
    from the first one's fails the conversion; columns are never shifted."""
    (spark.read.option("header", True).option("inferSchema", False).option("enforceSchema", False)
     .csv(csv_path).write.mode(mode).parquet(parquet_path))
