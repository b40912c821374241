"""Incremental star load from a landing folder (only files not seen before).

A Structured Streaming file source with a checkpoint remembers which files it
has consumed; ``trigger(availableNow=True)`` processes everything new and
stops, so a scheduled run reads only files that landed since the last run
(and a run with nothing new reads nothing).

Each micro-batch is typed, keyed and **appended** -- a truncate-load per batch
would keep only the newest batch.  Trip ids continue after the largest id
already loaded, read from a one-row-per-batch high-water-mark table (never a
scan of the fact), and the date dimension only gains keys it does not hold yet
(null-safe anti-join on ``datekey`` against prior keys pruned to the batch's
key range).  Every table is a folder partitioned by
``load_epoch``; a batch writes (overwrites) only its own epoch folder, so a
batch replayed after a failure replaces its earlier partial output instead of
duplicating it.

The fact and both location dimensions are stored as one keyed Parquet table
and read as column-pruned projections of it: a columnar read of three columns
costs the same either way, and each batch writes the trips once, not three times.

The analyses keep up with the loads: a batch adds its trips per vendor, which
are summed up on reading, and its rows of the analysis table.  Both come from
the batch alone, as a trip's locations are in its own batch.

Three sources: a stream of CSV files in the contract's column order; a stream of
CSV files of any headers (``by_header``), each read by its own; and
:meth:`IncrementalStarLoader.run_bookmarked` for Parquet folders and partitioned
catalog tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faretrail.functions.coerce import type_trips
from faretrail.functions.keys import STAGED, attach_dense_id, stage_positions, stage_ranked
from faretrail.operators import star
from faretrail.operators.aggregates import grouped_count
from faretrail.schemas import (ANALYSIS_COLUMNS, DROPOFF_DIM_COLUMNS, FACT_COLUMNS, PICKUP_DIM_COLUMNS,
                               TRIP_COLUMNS, raw_schema, resolve_column, spark_type)
from faretrail.session import path_exists, shuffles_dropped
from faretrail.sources.bookmarks import BookmarkedScan
from faretrail.sources.files import read_csv_by_header

EPOCH = "load_epoch"
HIGH_WATER = "_last_trip_id"
STATE = "_stream_state"
BOOKMARKS = "_bookmarks"
VENDOR_COUNTS, ANALYSIS = "vendor_counts", "analysis"
#: Files of a landing stream, by name alone.
FILE_STREAM = "path string, modificationTime timestamp, length long, content binary"
#: Names of those read by header: CSV, plain or packed.
LANDED_CSV = "*.csv{,.gz,.bz2,.deflate}"
KEYED_COLUMNS = FACT_COLUMNS + [c for c in PICKUP_DIM_COLUMNS + DROPOFF_DIM_COLUMNS
                                if c not in FACT_COLUMNS]
# table name -> (stored table, columns)
VIEWS = {
    "fact": ("trips", FACT_COLUMNS),
    "pickup": ("trips", PICKUP_DIM_COLUMNS),
    "dropoff": ("trips", DROPOFF_DIM_COLUMNS),
}


class IncrementalStarLoader:
    """Append-only star load from header CSV files landing in ``landing_dir``.

    A streaming source needs its schema up front, and a CSV schema applies by
    column position (a file with another header fails the batch): land files with :func:`faretrail.sinks.files.land_csv`
    (contract columns first, then ``extra_types`` columns in that order).
    With ``by_header`` the stream is one of file names, and each file is read by
    its own header: other orders, more or fewer columns (missing ones are NULL).

    A batch's shuffle files go with the query that wrote them, so that they don't lie beside what
    its later queries write.
    """

    def __init__(self, spark: SparkSession, landing_dir: str, warehouse_dir: str,
                 order_cols: list[str] | None = None,
                 extra_types: dict[str, str] | None = None,
                 max_files_per_trigger: int | None = None,
                 clean_source: str | None = None, archive_dir: str | None = None,
                 by_header: bool = False):
        """``clean_source='archive'`` (with ``archive_dir``) or ``'delete'``
        moves consumed files out of the landing folder, so its listing per
        trigger stays proportional to what is new, not to all history."""
        self.spark = spark
        self.landing_dir = landing_dir
        self.warehouse_dir = warehouse_dir.rstrip("/")
        self.order_cols = order_cols
        self.extra_types = extra_types
        self.max_files = max_files_per_trigger
        self.clean_source = clean_source
        self.archive_dir = archive_dir
        self.by_header = by_header

    def path(self, name: str) -> str:
        return f"{self.warehouse_dir}/{name}"

    def table(self, name: str, before_epoch: int | None = None,
              spark: SparkSession | None = None) -> DataFrame | None:
        """Loaded rows of one table (optionally only epochs before ``before_epoch``):
        ``fact``, ``pickup``, ``dropoff``, ``date``, ``analysis``, ``vendor_counts``."""
        stored, cols = VIEWS.get(name, (name, None))
        df = self._read(stored, spark or self.spark)
        if df is None:
            return None
        if before_epoch is not None:
            df = df.where(F.col(EPOCH) < before_epoch)
        if stored != HIGH_WATER:  # the mark is written last: an epoch without one isn't loaded
            marks = self._read(HIGH_WATER, spark or self.spark)
            if marks is None:
                return None
            df = df.join(marks.select(EPOCH), EPOCH, "left_semi")
        return df.select(*cols) if cols else df.drop(EPOCH)

    def _read(self, stored: str, spark: SparkSession) -> DataFrame | None:
        # only "nothing loaded yet" means empty; any other failure must
        # stop the batch (restarting ids at 1 would duplicate keys)
        return spark.read.parquet(self.path(stored)) if path_exists(spark, self.path(stored)) else None

    def run_available(self) -> None:
        """Load every file that landed since the previous run, then stop."""
        if path_exists(self.spark, self.path(HIGH_WATER)) and not path_exists(self.spark, self.path(STATE)):
            raise RuntimeError(f"{self.path(STATE)} is gone, but epochs are loaded: a new state would "
                               "number batches from 0 and replace them")
        reader = self.spark.readStream
        if self.by_header:
            reader = reader.format("binaryFile").schema(FILE_STREAM).option("pathGlobFilter", LANDED_CSV)
        else:  # a header that differs from the schema fails the batch; columns are never shifted
            reader = (reader.format("csv").schema(raw_schema(self.extra_types))
                      .option("header", True).option("enforceSchema", False))
        if self.max_files:
            reader = reader.option("maxFilesPerTrigger", self.max_files)
        if self.clean_source:
            reader = reader.option("cleanSource", self.clean_source)
            if self.archive_dir:
                reader = reader.option("sourceArchiveDir", self.archive_dir)
        landed = reader.load(self.landing_dir)
        if self.by_header:
            landed = landed.select("path")  # no file is opened for its name
        query = (landed.writeStream
                 .foreachBatch(self._load_files if self.by_header else self._load_batch)
                 .option("checkpointLocation", self.path(STATE))
                 .trigger(availableNow=True)
                 .start())
        query.awaitTermination()

    def run_bookmarked(self, source: str, is_table: bool = False, catalog_predicate: str | None = None,
                       push_down_predicate: str | None = None, max_files: int | None = None) -> int:
        """Load the Parquet files of a folder or a partitioned catalog table that no earlier run
        has loaded, as one epoch; returns their number.  Partition predicates narrow the run."""
        if path_exists(self.spark, self.path(STATE)):
            raise RuntimeError(f"the epochs of {self.warehouse_dir} are numbered by a stream")
        scan = BookmarkedScan(self.spark, source, self.path(BOOKMARKS), is_table, catalog_predicate, push_down_predicate)
        return scan.run(lambda rows, epoch: self._load_batch(self._typed_extras(rows), epoch), max_files)

    def _typed_extras(self, rows: DataFrame) -> DataFrame:
        for name, typ in (self.extra_types or {}).items():
            own = resolve_column(rows.columns, name)
            rows = rows.withColumn(own, F.col(own).try_cast(spark_type(typ)))
        return rows

    def _load_files(self, files: DataFrame, epoch: int) -> None:
        """Rows of a batch's files, each by its own header.  The names pass through the driver,
        as those of any scan; ``max_files_per_trigger`` bounds them."""
        paths = sorted(r["path"] for r in files.collect())
        rows = read_csv_by_header(files.sparkSession, paths, raw_schema(self.extra_types)) if paths else None
        if rows is not None:
            self._load_batch(rows, epoch)

    def vendor_trip_counts(self, vendors: DataFrame) -> DataFrame | None:
        """Trips per vendor, named, from the batches' counts: no trip is read."""
        counts = self.table(VENDOR_COUNTS)
        if counts is None:
            return None
        counts = counts.groupBy("vendorid").agg(F.sum("count").alias("count"))
        return (counts.join(vendors, counts["vendorid"] == vendors["VendorID"], "inner")
                .select(counts["vendorid"].alias("vendorid"), "count", vendors["VendorName"].alias("vendorname")))

    def _write(self, df: DataFrame, name: str, epoch: int) -> None:
        df.write.mode("overwrite").option("compression", STAGED).parquet(f"{self.path(name)}/{EPOCH}={epoch}")

    def _load_batch(self, batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession  # the micro-batch's own session
        with shuffles_dropped(spark):
            self._load_rows(batch, spark, epoch)

    def _load_rows(self, batch: DataFrame, spark: SparkSession, epoch: int) -> None:
        marks = self.table(HIGH_WATER, before_epoch=epoch, spark=spark)
        last_id = 0
        if marks is not None:
            last_id = marks.agg(F.max("last_trip_id")).first()[0] or 0
        typed = type_trips(batch)
        stage = (stage_positions(typed, "trips-batch") if self.order_cols is None
                 else stage_ranked(typed, self.order_cols, "trips-batch", copy=False, keep=list(TRIP_COLUMNS)))
        try:
            if stage.row_count():
                self._load_staged(stage, spark, epoch, last_id)
        finally:
            stage.release()

    def _load_staged(self, stage, spark: SparkSession, epoch: int, last_id: int) -> None:
        trips = star.with_location_ids(attach_dense_id(stage, start=last_id + 1))
        self._write(trips.select(*KEYED_COLUMNS), "trips", epoch)
        # what the batch adds to the analyses, from the batch alone
        self._write(grouped_count(trips, "VendorID", "vendorid"), VENDOR_COUNTS, epoch)
        self._write(trips.select(*[F.col(resolve_column(trips.columns, c)).alias(c) for c in ANALYSIS_COLUMNS]), ANALYSIS, epoch)
        dates = star.date_dim(trips)
        prior_dates = self.table("date", before_epoch=epoch, spark=spark)
        if prior_dates is not None:
            lo, hi = trips.agg(
                F.least(F.min("tpep_pickup_datetime"), F.min("tpep_dropoff_datetime")),
                F.greatest(F.max("tpep_pickup_datetime"), F.max("tpep_dropoff_datetime"))).first()
            # only prior keys inside this batch's range can collide (row groups
            # outside it are skipped by the Parquet min/max statistics)
            in_range = F.col("datekey").isNull()
            if lo is not None:
                in_range = in_range | F.col("datekey").between(lo, hi)
            known = prior_dates.where(in_range).select(F.col("datekey").alias("_known"))
            dates = dates.join(known, dates["datekey"].eqNullSafe(known["_known"]), "left_anti")
        self._write(dates, "date", epoch)
        n = stage.row_count()
        mark = spark.range(1).select(F.lit(last_id + n).cast("long").alias("last_trip_id"))
        self._write(mark, HIGH_WATER, epoch)
