"""Surrogate keys.

``dense_key`` gives every row its 1-based rank in a total order over the given
columns -- the same value as ``row_number() OVER (ORDER BY ...)`` -- without
pulling rows into one partition:

1. a global sort (range partitioning on the full order key, so even a hot
   leading value is split across many tasks);
2. each row records its sort partition and its position inside it
   (``spark_partition_id`` / ``monotonically_increasing_id``);
3. the result is written once to the shared folder, which fixes the sampled
   range bounds and positions for every later reader and cuts the lineage;
4. per-partition row counts (one row per sort partition) become offsets by a
   running sum, written once next to the staging.  That table's size is
   bounded by the partition count, not by the data, so it is broadcast.

The ids are computed on read from the staged columns, so every table derived
from one staging (fact, location dimensions) sees the same ids.

``monotonic_key`` is the cheap sparse variant: unique and increasing, but the
values depend on how the input was split -- stage it before deriving several
tables from it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faretrail.session import drop_scratch, scratch_path

PART = "_key_part"
POS = "_key_pos"
OFFSET = "_key_offset"
FIRST = "_key_first_pos"
LANDING_POS = "_landing_pos"
FILE = "_key_file"
START = "_key_start"
BLOCK = "_key_block"
#: Codec of what is staged: written once, read a few times, then removed.
STAGED = "zstd"


def _order(cols: list[str | Column]) -> list[Column]:
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in cols]


@dataclass
class RankedStage:
    """A staged global ranking: rows with (partition, position), plus offsets."""
    rows: DataFrame
    offsets: DataFrame
    paths: tuple[str, ...] = ()
    by: tuple[str, ...] = (PART,)

    def release(self) -> None:
        """Remove the staged files; call once no frame built on them is read again."""
        for path in self.paths:
            drop_scratch(self.rows.sparkSession, path)

    def row_count(self) -> int:
        """Rows staged (sum over the small offsets table; no data scan)."""
        r = self.offsets.agg(F.sum("_rows")).first()[0]
        return int(r or 0)


def stage_ranked(df: DataFrame, order_cols: list[str | Column], label: str = "ranked",
                 copy: bool = True, keep: list[str] | None = None) -> RankedStage:
    """Sort globally, tag partition and position, write once, read back.

    The input is written before: a range sort reads it twice (bounds, rows), which would
    run it twice.  That first copy is removed at once.  ``copy=False`` is for input that is cheaper
    to run again behind its last shuffle or scan than to write, and that observes nothing.
    ``keep``: the columns to stage, where those of the order alone aren't needed behind it.
    """
    spark = df.sparkSession
    if not copy:
        return _staged(_ranked(df, order_cols, keep), label)
    input_path = scratch_path(spark, label + "-input")
    df.write.mode("errorifexists").option("compression", STAGED).parquet(input_path)
    staged = _staged(_ranked(spark.read.parquet(input_path), order_cols, keep), label)
    drop_scratch(spark, input_path)
    return staged


def _ranked(df: DataFrame, order_cols: list[str | Column], keep: list[str] | None) -> DataFrame:
    rows = df.orderBy(*_order(order_cols))
    return rows.select(*keep) if keep else rows


def stage_positions(df: DataFrame, label: str = "positions") -> RankedStage:
    """Tag partition and position in the scan, write once, read back: an order without a
    shuffle, for rows that have no natural key.  Which id a row gets depends on the splits."""
    return _staged(df, label)


def stage_file_positions(df: DataFrame, label: str = "file-positions") -> RankedStage:
    """Tag file, split and place of every row of a file scan, write once, read back: the order of
    the files by name, and of the rows in each, whatever the splits.

    ``df`` reads files and has only been projected or filtered, so a split's rows follow each
    other in one task, in the order of the file, and the offsets of the splits by their starts
    make them one sequence.  No shuffle; the offsets have a row of some tens of bytes a split.
    """
    spark = df.sparkSession
    tagged = (df.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(START))
              .withColumns({PART: F.spark_partition_id(), POS: F.monotonically_increasing_id(), BLOCK: F.xxhash64(FILE, START)}))
    path = scratch_path(spark, label)
    tagged.write.mode("errorifexists").option("compression", STAGED).parquet(path)
    rows = spark.read.parquet(path)
    splits = rows.groupBy(PART, BLOCK, FILE, START).agg(F.count(F.lit(1)).alias("_rows"), F.min(POS).alias(FIRST))
    running = Window.orderBy(FILE, START).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = splits.select(PART, BLOCK, "_rows", FIRST, (F.sum("_rows").over(running) - F.col("_rows")).alias(OFFSET))
    offsets.coalesce(1).write.mode("errorifexists").parquet(path + "-offsets")
    return RankedStage(rows.drop(FILE, START), spark.read.parquet(path + "-offsets"), (path, path + "-offsets"), (PART, BLOCK))


def _staged(df: DataFrame, label: str) -> RankedStage:
    spark = df.sparkSession
    tagged = (df.withColumn(PART, F.spark_partition_id())
              .withColumn(POS, F.monotonically_increasing_id()))
    path = scratch_path(spark, label)
    tagged.write.mode("errorifexists").option("compression", STAGED).parquet(path)
    rows = spark.read.parquet(path)
    counts = rows.groupBy(PART).agg(F.count(F.lit(1)).alias("_rows"), F.min(POS).alias(FIRST))
    # One row per sort partition: a single-partition running sum is cheap here.
    running = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = counts.select(PART, "_rows", FIRST,
                            (F.sum("_rows").over(running) - F.col("_rows")).alias(OFFSET))
    offsets.coalesce(1).write.mode("errorifexists").parquet(path + "-offsets")
    return RankedStage(rows, spark.read.parquet(path + "-offsets"), (path, path + "-offsets"))


def attach_dense_id(stage: RankedStage, id_col: str = "trip_id",
                    start: int | Column = 1) -> DataFrame:
    """Turn (partition, position) of a staged ranking into a dense 1-based id.

    Positions inside one partition are consecutive record numbers, so a row's
    rank inside its partition (or split) is its position minus the first one.
    """
    local = F.col(POS) - F.col(FIRST)
    start_col = start if isinstance(start, Column) else F.lit(start)
    offsets = stage.offsets.select(*stage.by, OFFSET, FIRST)
    return (stage.rows.join(F.broadcast(offsets), list(stage.by))
            .withColumn(id_col, (F.col(OFFSET) + local + start_col.cast("long")).cast("long"))
            .drop(*stage.by, POS, OFFSET, FIRST))


def dense_key(df: DataFrame, order_cols: list[str | Column], id_col: str = "trip_id",
              start: int | Column = 1, label: str = "ranked") -> DataFrame:
    """Add ``id_col`` = dense rank of each row in ``order_cols`` (asc, nulls last)."""
    keyed = attach_dense_id(stage_ranked(df, order_cols, label), id_col, start)
    return keyed.select(id_col, *[c for c in keyed.columns if c != id_col])


def with_landing_position(df: DataFrame) -> DataFrame:
    """Tag rows of a file scan with their position in the scan.

    Use directly on a file read: the position is stable under task retries
    and breaks ties between identical rows, so a hot group of exact copies
    is still split by the range partitioner.
    """
    return df.withColumn(LANDING_POS, F.monotonically_increasing_id())


def monotonic_key(df: DataFrame, id_col: str = "trip_id") -> DataFrame:
    """``monotonically_increasing_id() + 1``: unique, sparse, split-dependent."""
    return df.withColumn(id_col, F.monotonically_increasing_id() + 1)
