"""Registered queries (``name -> callable(spark, sf_dir)``) and their DuckDB oracles.

Every query reads the driver's tables (through the trip lens) over their
whole extent; nothing is sampled, capped or filtered to keep a check cheap.
Oracle SQL runs in DuckDB over views of the same parquet files and names every
output column exactly as the Spark side does.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faretrail.functions.coerce import type_trips
from faretrail.functions.dates import date_text as _date_text
from faretrail.functions.keys import dense_key, monotonic_key
from faretrail.operators import aggregates, star
from faretrail.operators import preview as preview_ops
from faretrail.plans import analysis, warehouse
from faretrail.schemas import TRIP_COLUMNS
from faretrail.session import drop_scratch, scratch_path, shuffles_dropped, unique_name
from faretrail.sinks import files as sink_files
from faretrail.sinks.compaction import compact
from faretrail.sinks.tables import stage, truncate_load
from faretrail.sources import files as src_files
from faretrail.sources import lens, literals
from faretrail.streaming.incremental import IncrementalStarLoader

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn: Query) -> Query:
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn
    return wrap


# ---------------------------------------------------------------- oracle pieces

LENS_CTE = "lens AS (" + lens.lens_sql() + ")"
NK_ORDER = ", ".join(f"{c} ASC NULLS LAST" for c in lens.NATURAL_KEY)
TRIP_COLS_SQL = ", ".join(TRIP_COLUMNS)
FACT_SQL = ("trip_id, VendorID, passenger_count, tpep_pickup_datetime, tpep_dropoff_datetime, "
            "trip_distance, RatecodeID, payment_type, fare_amount, extra, mta_tax, tip_amount, "
            "tolls_amount, improvement_surcharge, total_amount, "
            "trip_id AS pickup_location_id, trip_id AS dropff_location_id")
KEYED_CTE = (LENS_CTE + ", keyed AS (SELECT CAST(row_number() OVER (ORDER BY " + NK_ORDER
             + ") AS BIGINT) AS trip_id, * FROM lens)")
DATEKEYS_CTE = (LENS_CTE + ", datekeys AS (SELECT tpep_pickup_datetime AS datekey FROM lens "
                "UNION SELECT tpep_dropoff_datetime FROM lens)")
DATE_DIM_SQL = ("SELECT datekey, CAST(datekey AS DATE) AS date, strftime(datekey, '%y') AS year_yy, "
                "CAST(year(datekey) AS VARCHAR) AS year_yyyy, strftime(datekey, '%B') AS month "
                "FROM datekeys")


def vendor_dim_sql() -> str:
    return ("SELECT CAST(k AS INTEGER) AS VendorID, v AS VendorName FROM (VALUES "
            "(1, 'Creative Mobile Technologies'), (2, 'VeriFone Inc.')) t(k, v)")


def rate_dim_sql() -> str:
    return ("SELECT CAST(k AS VARCHAR) AS RatecodeID, v AS RatecodeName FROM (VALUES "
            "(1, 'Standard rate'), (2, 'JFK'), (3, 'Newark'), (4, 'Nassau or Westchester'), "
            "(5, 'Negotiated fare'), (6, 'Group ride')) t(k, v)")


PAYMENT_SQL = ("SELECT CAST(k AS INTEGER) AS payment_type, v AS payment_type_name FROM (VALUES "
               "(1, 'Credit card'), (2, 'Cash'), (3, 'No charge'), (4, 'Dispute'), (5, 'Unknown'), "
               "(6, 'Voided trip')) t(k, v)")


# ---------------------------------------------------------------- shared builders

def _keyed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing text -> typed -> dense ids in natural-key order -> location ids."""
    return star.key_trips(lens.raw_trip_lens(spark, sf_dir), order_cols=lens.NATURAL_KEY)


def _warehouse_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed trips from typed input (what the warehouse holds after a load)."""
    return star.key_trips(lens.trip_lens(spark, sf_dir), order_cols=lens.NATURAL_KEY, keep=list(TRIP_COLUMNS))


def _typed_from_landing(df: DataFrame) -> DataFrame:
    return type_trips(df).select(*LENS_COLUMNS)


LENS_COLUMNS = lens.NATURAL_KEY + list(TRIP_COLUMNS)
ANALYSIS_SQL = ("trip_id, VendorID AS vendorid, trip_distance, tpep_pickup_datetime, "
                "tpep_dropoff_datetime, trip_id AS pickup_location_id, pickup_longitude, "
                "pickup_latitude, trip_id AS dropff_location_id, dropoff_longitude, dropoff_latitude")
DAY_PARTS_SQL = ("CAST(year(tpep_pickup_datetime) AS INTEGER) AS year, "
                 "CAST(month(tpep_pickup_datetime) AS INTEGER) AS month, "
                 "CAST(day(tpep_pickup_datetime) AS INTEGER) AS date")


# ---------------------------------------------------------------- analysis

@register("vendor_trip_counts", f"""
WITH {LENS_CTE}, counts AS (SELECT VendorID AS vendorid, count(*) AS count FROM lens GROUP BY VendorID)
SELECT c.vendorid AS vendorid, c.count AS count, v.VendorName AS vendorname
FROM counts c JOIN ({vendor_dim_sql()}) v ON c.vendorid = v.VendorID
""")
def vendor_trip_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.vendor_trip_counts(lens.trip_lens(spark, sf_dir), literals.vendor_dim(spark))


@register("vendor_counts", f"""
WITH {LENS_CTE} SELECT VendorID AS vendorid, count(*) AS count FROM lens GROUP BY VendorID
""")
def vendor_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.grouped_count(lens.trip_lens(spark, sf_dir), "vendorid", "vendorid")


@register("vendor_counts_sql", f"""
WITH {LENS_CTE} SELECT VendorID, count(*) AS count FROM lens GROUP BY VendorID
""")
def vendor_counts_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.grouped_count_sql(lens.trip_lens(spark, sf_dir), "VendorID")


@register("row_count", f"WITH {LENS_CTE} SELECT count(*) AS n FROM lens")
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.row_count(lens.trip_lens(spark, sf_dir))


# ---------------------------------------------------------------- typing and keys

@register("lenient_casts", f"WITH {LENS_CTE} SELECT * FROM lens")
def lenient_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_trips(lens.raw_trip_lens(spark, sf_dir))


@register("typed_trips", f"""
WITH {KEYED_CTE}
SELECT trip_id, {', '.join(lens.NATURAL_KEY)}, {TRIP_COLS_SQL},
       trip_id AS pickup_location_id, trip_id AS dropff_location_id FROM keyed
""")
def typed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed_trips(spark, sf_dir)


@register("surrogate_key_dense", f"""
WITH {KEYED_CTE} SELECT trip_id, {', '.join(lens.NATURAL_KEY)} FROM keyed
""")
def surrogate_key_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = dense_key(lens.trip_lens(spark, sf_dir).select(*lens.NATURAL_KEY), lens.NATURAL_KEY)
    return keyed.select("trip_id", *lens.NATURAL_KEY)


@register("surrogate_key_monotonic", """
SELECT count(*) AS n, count(*) AS n_distinct, count(*) AS n_positive FROM lineitem
""")
def surrogate_key_monotonic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse ids are unique and >= 1 however the scan is split (their values
    depend on the split, so only these properties are compared)."""
    keyed = monotonic_key(lens.table(spark, sf_dir, "lineitem"))
    return keyed.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("trip_id").alias("n_distinct"),
                     F.count(F.when(F.col("trip_id") >= 1, 1)).alias("n_positive"))


# ---------------------------------------------------------------- star tables

@register("fact_trips", f"WITH {KEYED_CTE} SELECT {FACT_SQL} FROM keyed")
def fact_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fact_trips(_keyed_trips(spark, sf_dir))


@register("dim_pickup_location", f"""
WITH {KEYED_CTE} SELECT trip_id AS pickup_location_id, pickup_longitude, pickup_latitude FROM keyed
""")
def dim_pickup_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.pickup_location_dim(_keyed_trips(spark, sf_dir))


@register("dim_dropoff_location", f"""
WITH {KEYED_CTE} SELECT trip_id AS dropff_location_id, dropoff_longitude, dropoff_latitude FROM keyed
""")
def dim_dropoff_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dropoff_location_dim(_keyed_trips(spark, sf_dir))


@register("union_timestamps", f"""
WITH {LENS_CTE} SELECT tpep_pickup_datetime AS datekey FROM lens
UNION ALL SELECT tpep_dropoff_datetime FROM lens
""")
def union_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.union_timestamps(type_trips(lens.raw_trip_lens(spark, sf_dir)))


@register("dim_date", f"WITH {DATEKEYS_CTE} {DATE_DIM_SQL}")
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.date_dim(type_trips(lens.raw_trip_lens(spark, sf_dir)))


@register("dim_date_prededup", f"WITH {DATEKEYS_CTE} {DATE_DIM_SQL}")
def dim_date_prededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.date_dim_prededup(type_trips(lens.raw_trip_lens(spark, sf_dir)), 44)


@register("dedup_rows", f"WITH {DATEKEYS_CTE} {DATE_DIM_SQL}")
def dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.date_dim_dedup_rows(type_trips(lens.raw_trip_lens(spark, sf_dir)))


@register("date_text", f"""
WITH {LENS_CTE} SELECT {', '.join(lens.NATURAL_KEY)},
  strftime(tpep_pickup_datetime, '%Y-%m-%d') AS pickup_date FROM lens
""")
def date_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = type_trips(lens.raw_trip_lens(spark, sf_dir))
    return trips.select(*lens.NATURAL_KEY, _date_text("tpep_pickup_datetime").alias("pickup_date"))


# ---------------------------------------------------------------- joins

_TRIP_VENDOR_SQL = f"""
WITH {KEYED_CTE} SELECT k.trip_id AS trip_id, k.VendorID AS VendorID, v.VendorName AS VendorName
FROM keyed k JOIN ({vendor_dim_sql()}) v ON k.VendorID = v.VendorID
"""


def _trip_vendor(strategy: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        fact = star.fact_trips(_warehouse_trips(spark, sf_dir))
        return analysis.trip_vendor(fact, literals.vendor_dim(spark), strategy)
    return run


register("trip_vendor_broadcast_dim", _TRIP_VENDOR_SQL)(_trip_vendor("auto"))
register("trip_vendor_sortmerge", _TRIP_VENDOR_SQL)(_trip_vendor("merge"))


@register("trip_vendor_broadcast_fact", _TRIP_VENDOR_SQL)
def trip_vendor_broadcast_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hint on the large side: the trips go to the vendors while their counted rows are proven
    to stay below the bound; beyond it they are joined by a salted shuffle."""
    stages: list = []
    trips = star.key_trips(lens.trip_lens(spark, sf_dir), order_cols=lens.NATURAL_KEY, stages=stages)
    return analysis.trip_vendor(star.fact_trips(trips), literals.vendor_dim(spark), "broadcast_fact", stages[0].row_count())


@register("trip_locations", f"WITH {KEYED_CTE} SELECT {ANALYSIS_SQL} FROM keyed")
def trip_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = _warehouse_trips(spark, sf_dir)
    return analysis.trip_locations(star.fact_trips(trips), star.pickup_location_dim(trips),
                                   star.dropoff_location_dim(trips), copied_ids=True)


@register("trip_locations_renamed", f"WITH {KEYED_CTE} SELECT {ANALYSIS_SQL} FROM keyed")
def trip_locations_renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = _warehouse_trips(spark, sf_dir)
    return analysis.trip_locations_renamed(star.fact_trips(trips), star.pickup_location_dim(trips),
                                           star.dropoff_location_dim(trips), copied_ids=True)


@register("rate_code_counts", f"""
WITH {LENS_CTE}, counts AS (SELECT RatecodeID, count(*) AS count FROM lens GROUP BY RatecodeID)
SELECT c.RatecodeID AS RatecodeID, r.RatecodeName AS RatecodeName, c.count AS count
FROM counts c JOIN ({rate_dim_sql()}) r ON c.RatecodeID = CAST(r.RatecodeID AS INTEGER)
""")
def rate_code_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.rate_code_counts(lens.trip_lens(spark, sf_dir), literals.rate_code_dim(spark))


@register("preview_trips", f"WITH {KEYED_CTE} SELECT {FACT_SQL} FROM keyed ORDER BY trip_id LIMIT 20")
def preview_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview_ops.preview(star.fact_trips(_keyed_trips(spark, sf_dir)), 20, "trip_id")


@register("partition_stats", f"""
WITH {LENS_CTE} SELECT CAST(16 AS BIGINT) AS partitions, count(*) AS rows,
  CAST(ceil(count(*) / 16.0) AS BIGINT) AS largest_partition_rows FROM lens
""")
def partition_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of the fact's partitions, dealt into 16 by its dense trip id."""
    fact = star.fact_trips(_keyed_trips(spark, sf_dir))
    return preview_ops.partition_stats(preview_ops.dealt(fact, 16, F.col("trip_id")))


# ---------------------------------------------------------------- sources

_LENS_ALL = f"WITH {LENS_CTE} SELECT * FROM lens"


@register("scan_csv", _LENS_ALL)
def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = scratch_path(spark, "landing-csv")
    sink_files.land_csv(lens.raw_trip_lens(spark, sf_dir), landing)
    raw = src_files.read_trips_csv(spark, landing, extra_types=lens.NATURAL_KEY_TYPES)
    return _typed_from_landing(raw)


@register("scan_csv_reordered", _LENS_ALL)
def scan_csv_reordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files with their own column order and one more column, read by header name."""
    landing = scratch_path(spark, "landing-csv-reordered")
    raw = lens.raw_trip_lens(spark, sf_dir)
    own = raw.select(F.lit("x").alias("note"), *reversed(raw.columns))
    own.write.option("header", True).csv(landing)
    return _typed_from_landing(src_files.read_trips_csv(spark, landing, extra_types=lens.NATURAL_KEY_TYPES))


@register("scan_csv_stamped", f"WITH {LENS_CTE} SELECT * FROM lens WHERE year(tpep_pickup_datetime) <= 1997")
def scan_csv_stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three drops stamped with their minute; the pattern of one hour picks the first two."""
    landing = scratch_path(spark, "landing-csv-stamped")
    raw = lens.raw_trip_lens(spark, sf_dir)
    year = F.year(F.col("tpep_pickup_datetime").try_cast("timestamp_ntz"))
    drops = [(datetime(2024, 5, 5, 0, 1), year < 1995), (datetime(2024, 5, 5, 0, 3), year.between(1995, 1997)),
             (datetime(2024, 5, 6, 0, 1), F.coalesce(year > 1997, F.lit(True)))]
    for at, own in drops:
        sink_files.land_csv_stamped(raw.where(own), landing, at)
    picked = src_files.read_trips_csv(spark, f"{landing}/trips-2024-5-5-0-*",
                                      extra_types=lens.NATURAL_KEY_TYPES)
    return _typed_from_landing(picked)


@register("csv_to_parquet", _LENS_ALL)
def csv_to_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = scratch_path(spark, "landing-csv")
    converted = scratch_path(spark, "landing-parquet")
    sink_files.land_csv(lens.raw_trip_lens(spark, sf_dir), landing)
    sink_files.csv_to_parquet(spark, landing, converted)
    raw = src_files.read_trips_parquet(spark, converted)
    for name, typ in lens.NATURAL_KEY_TYPES.items():
        raw = raw.withColumn(name, F.col(name).try_cast(typ))
    return _typed_from_landing(raw)


@register("scan_csv_glob", f"""
WITH {LENS_CTE} SELECT * FROM lens WHERE year(tpep_pickup_datetime) IN (1996, 1997)
""")
def scan_csv_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = scratch_path(spark, "landing-csv-years")
    by_year = lens.trip_lens(spark, sf_dir).withColumn("pickup_year", F.year(F.col("tpep_pickup_datetime").try_cast("timestamp_ntz")))
    sink_files.write_partitioned(sink_files.landing_order(by_year), landing, ("pickup_year",), fmt="csv",
                                 finish=lens.as_landing_text)
    picked = src_files.read_trips_csv(spark, f"{landing}/pickup_year=199[67]/*.csv",
                                      extra_types=lens.NATURAL_KEY_TYPES)
    return _typed_from_landing(picked)


@register("scan_parquet", _LENS_ALL)
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = scratch_path(spark, "landing-parquet")
    sink_files.write_parquet(lens.raw_trip_lens(spark, sf_dir), landing)
    return _typed_from_landing(src_files.read_trips_parquet(spark, f"{landing}/*.parquet"))


@register("scan_recursive", _LENS_ALL)
def scan_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = scratch_path(spark, "landing-nested")
    raw = sink_files.with_day_partitions(lens.raw_trip_lens(spark, sf_dir))
    sink_files.write_partitioned(raw, landing, ("year", "month"))
    return _typed_from_landing(src_files.read_trips_parquet(spark, landing, recursive=True))


@register("sink_partitioned", f"WITH {LENS_CTE} SELECT *, {DAY_PARTS_SQL} FROM lens")
def sink_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "trips-by-day")
    sink_files.write_partitioned(sink_files.with_day_partitions(lens.trip_lens(spark, sf_dir)), out)
    return spark.read.parquet(out)


@register("scan_partitioned", f"""
WITH {LENS_CTE} SELECT *, {DAY_PARTS_SQL} FROM lens
WHERE year(tpep_pickup_datetime) = 1996 AND month(tpep_pickup_datetime) = 5 AND day(tpep_pickup_datetime) >= 28
""")
def scan_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = scratch_path(spark, "landing-hive")
    raw = sink_files.with_day_partitions(lens.raw_trip_lens(spark, sf_dir))
    sink_files.write_partitioned(raw, landing)
    name = src_files.register_partitioned_table(spark, unique_name("trips_hive"), landing)
    found = src_files.read_partitioned(spark, name, catalog_predicate="year = '1996' and month = '5'",
                                       push_down_predicate="date >= 28", is_table=True)
    return type_trips(found).select(*LENS_COLUMNS, "year", "month", "date")


@register("incremental_load", f"""
WITH {LENS_CTE}, keyed AS (
  SELECT CAST(row_number() OVER (ORDER BY
    CASE WHEN year(tpep_pickup_datetime) > 1997 THEN 1 ELSE 0 END, {NK_ORDER}) AS BIGINT) AS trip_id, *
  FROM lens)
SELECT {FACT_SQL} FROM keyed
""")
def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = scratch_path(spark, "landing-stream")
    loader = IncrementalStarLoader(spark, landing, scratch_path(spark, "warehouse-incremental"),
                                   order_cols=lens.NATURAL_KEY, extra_types=lens.NATURAL_KEY_TYPES)
    trips = stage(lens.trip_lens(spark, sf_dir), "landings")  # joined once for both
    later = F.coalesce(F.year("tpep_pickup_datetime") > 1997, F.lit(False))
    sink_files.land_csv(lens.as_landing_text(trips.where(~later)), landing, compression="gzip")
    loader.run_available()
    loader.run_available()  # nothing new: reads no file, loads nothing
    sink_files.land_csv(lens.as_landing_text(trips.where(later)), landing, compression="gzip")
    loader.run_available()
    return loader.table("fact")


# Three landings one after another: which of them a trip comes with.
_LANDING_SQL = "CASE WHEN year(tpep_pickup_datetime) > 1996 THEN 2 WHEN year(tpep_pickup_datetime) > 1993 THEN 1 ELSE 0 END"
_LANDED_CTE = (LENS_CTE + ", keyed AS (SELECT CAST(row_number() OVER (ORDER BY " + _LANDING_SQL + ", " + NK_ORDER
               + ") AS BIGINT) AS trip_id, * FROM lens)")


def _landings(spark: SparkSession, sf_dir: str, paths: list[str] | None = None) -> list[DataFrame]:
    with shuffles_dropped(spark):
        trips = stage(lens.trip_lens(spark, sf_dir), "landings", paths)  # joined once for the three
    return [lens.as_landing_text(trips.where(F.expr(_LANDING_SQL) == k)) for k in range(3)]


def _loaded_in_three(spark: SparkSession, sf_dir: str) -> IncrementalStarLoader:
    landing = scratch_path(spark, "landing-stream")
    loader = IncrementalStarLoader(spark, landing, scratch_path(spark, "warehouse-incremental"),
                                   order_cols=lens.NATURAL_KEY, extra_types=lens.NATURAL_KEY_TYPES)
    for part in _landings(spark, sf_dir):
        sink_files.land_csv(part, landing, compression="gzip")
        loader.run_available()
    return loader


@register("incremental_vendor_counts", _ORACLES["vendor_trip_counts"])
def incremental_vendor_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips per vendor after three landings, summed from what each has added."""
    return _loaded_in_three(spark, sf_dir).vendor_trip_counts(literals.vendor_dim(spark))


@register("incremental_analysis", f"WITH {_LANDED_CTE} SELECT {ANALYSIS_SQL} FROM keyed")
def incremental_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The analysis table after three landings, each of which only added its rows."""
    return _loaded_in_three(spark, sf_dir).table("analysis")


@register("incremental_headers", f"WITH {KEYED_CTE} SELECT {FACT_SQL} FROM keyed")
def incremental_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landing of files with three headers: the contract's, another order, and other letter
    cases with one more column."""
    landing, staged = scratch_path(spark, "landing-headers"), []
    first, second, third = _landings(spark, sf_dir, staged)
    sink_files.land_csv(first, landing, compression="gzip")
    sink_files.land_csv(second.select(*reversed(second.columns)), landing, compression="gzip", own_order=True)
    other = third.select(F.lit("x, y").alias("note"), *[F.col(c).alias(c.upper()) for c in sorted(third.columns)])
    sink_files.land_csv(other, landing, compression="gzip", own_order=True)
    for path in staged:  # all trips have landed
        drop_scratch(spark, path)
    loader = IncrementalStarLoader(spark, landing, scratch_path(spark, "warehouse-incremental"),
                                   order_cols=lens.NATURAL_KEY, extra_types=lens.NATURAL_KEY_TYPES, by_header=True)
    loader.run_available()
    loader.run_available()  # nothing new
    return loader.table("fact")


@register("incremental_parquet", f"WITH {_LANDED_CTE} SELECT {FACT_SQL} FROM keyed")
def incremental_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned catalog table loaded as it grows: first the folders of a predicate, then
    those that it left, then new ones; a run without any in between reads nothing."""
    landing = scratch_path(spark, "landing-bookmarked")
    parts = [sink_files.with_day_partitions(p, names=("year", "month", "date")).drop("date") for p in _landings(spark, sf_dir)]
    sink_files.write_partitioned(parts[0].unionByName(parts[1]), landing, ("year", "month"))
    table = src_files.register_partitioned_table(spark, unique_name("trips_growing"), landing)
    loader = IncrementalStarLoader(spark, landing, scratch_path(spark, "warehouse-incremental"),
                                   order_cols=lens.NATURAL_KEY, extra_types=lens.NATURAL_KEY_TYPES)
    # a row without a date is of the first landing
    loader.run_bookmarked(table, is_table=True, catalog_predicate="year <= 1993 OR year IS NULL")
    loader.run_bookmarked(table, is_table=True)
    loader.run_bookmarked(table, is_table=True)  # nothing new
    sink_files.write_partitioned(parts[2], landing, ("year", "month"), mode="append")
    src_files.register_partitioned_table(spark, table, landing)
    loader.run_bookmarked(table, is_table=True)
    return loader.table("fact")


@register("sink_partitioned_again", f"""
WITH {LENS_CTE}, days AS (SELECT *, {DAY_PARTS_SQL} FROM lens),
marked AS (SELECT *, bool_or(l_linenumber % 2 = 1) OVER (PARTITION BY year, month, date) AS again FROM days)
SELECT * EXCLUDE (again) FROM marked WHERE NOT (again AND year = 1996 AND month = 5) OR l_linenumber % 2 = 1
""")
def sink_partitioned_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days landed, then the days of one month again with half of their trips: these folders are
    replaced, all others stay."""
    out = scratch_path(spark, "trips-by-day")
    days = sink_files.with_day_partitions(lens.trip_lens(spark, sf_dir))
    sink_files.write_partitioned(days, out)
    sink_files.write_partitioned(days.where("year = 1996 AND month = 5 AND l_linenumber % 2 = 1"), out, mode="replace_partitions")
    return spark.read.parquet(out)


@register("scan_compacted", _LENS_ALL)
def scan_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing folder of 120 small files, packed into a few, read back."""
    landing = scratch_path(spark, "landing-small")
    dealt = lens.trip_lens(spark, sf_dir).repartition(120, *lens.NATURAL_KEY)  # typed rows are narrower than text
    lens.as_landing_text(dealt).write.parquet(landing)
    compact(spark, landing)
    return _typed_from_landing(src_files.read_trips_parquet(spark, landing))


#: Splits of a small reading at most: each is a task and a staged file.
SMALL_SPLITS = 2048


@register("surrogate_key_files", f"""
WITH {LENS_CTE}, keyed AS (SELECT CAST(row_number() OVER (ORDER BY {NK_ORDER}) AS BIGINT) AS trip_id, * FROM lens)
SELECT reading, trip_id, {', '.join(lens.NATURAL_KEY)} FROM keyed, (VALUES ('small splits'), ('large splits')) r(reading)
""")
def surrogate_key_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids by file and place in it, of one landing read in splits of 32 kB and of 128 MB; a landing
    of more than ``SMALL_SPLITS`` splits of 32 kB is read in so many of more.

    The landing's files follow each other in the order of the natural key, so the ids must be
    its ranks, both times."""
    landing = scratch_path(spark, "landing-ordered")
    order = [F.col(c).asc_nulls_last() for c in lens.NATURAL_KEY]
    # typed rows are dealt and sorted, text is made behind; as many files as the rows need
    ordered = lens.trip_lens(spark, sf_dir).repartitionByRange(*order).sortWithinPartitions(*order)
    lens.as_landing_text(ordered).write.option("header", True).csv(landing)
    found = []
    for reading, size in (("small splits", src_files.split_bytes(spark, landing, ".csv", 32 << 10, SMALL_SPLITS)), ("large splits", 128 << 20)):
        own = spark.newSession()  # the caller's settings stay
        own.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        own.conf.set("spark.sql.files.openCostInBytes", "4k")
        trips = star.key_trips(src_files.read_trips_csv(own, landing, extra_types=lens.NATURAL_KEY_TYPES), key="files")
        path = scratch_path(spark, "ids")
        trips.select(F.lit(reading).alias("reading"), "trip_id", *lens.NATURAL_KEY).write.parquet(path)
        found.append(path)
    return spark.read.parquet(*found)


# ---------------------------------------------------------------- loads

@register("sink_truncate_load", f"WITH {KEYED_CTE} SELECT {FACT_SQL} FROM keyed")
def sink_truncate_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = star.fact_trips(_warehouse_trips(spark, sf_dir))
    name = unique_name("FactTable")
    location = scratch_path(spark, "warehouse") + "/" + name
    truncate_load(fact, name, location)
    truncate_load(fact, name, location)  # second load replaces, never appends
    return spark.table(name)


@register("analysis_table_load", f"WITH {KEYED_CTE} SELECT {ANALYSIS_SQL} FROM keyed")
def analysis_table_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = _warehouse_trips(spark, sf_dir)
    result = analysis.trip_locations(star.fact_trips(trips), star.pickup_location_dim(trips),
                                     star.dropoff_location_dim(trips), copied_ids=True)
    name = unique_name("analysis_table")
    truncate_load(result, name, scratch_path(spark, "warehouse") + "/" + name)
    return spark.table(name)


@register("star_build_counts", f"""
WITH {DATEKEYS_CTE}
SELECT 'FactTable' AS table_name, count(*) AS row_count FROM lens
UNION ALL SELECT 'PaymentTypesDim', CAST(6 AS BIGINT)
UNION ALL SELECT 'PickupLocationsDim', count(*) FROM lens
UNION ALL SELECT 'DropOffLocationsDim', count(*) FROM lens
UNION ALL SELECT 'DateDim', count(*) FROM datekeys
UNION ALL SELECT 'RateCodesDim', CAST(6 AS BIGINT)
UNION ALL SELECT 'VendorsDim', CAST(2 AS BIGINT)
""")
def star_build_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = warehouse.build_and_load(spark, lens.raw_trip_lens(spark, sf_dir), "_" + unique_name("run"),
                                      scratch_path(spark, "warehouse"), order_cols=lens.NATURAL_KEY)
    return warehouse.table_counts(spark, loaded)


@register("star_switch", f"WITH {KEYED_CTE} SELECT {FACT_SQL}, pickup_longitude FROM keyed WHERE VendorID = 1")
def star_switch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of one set, the second of some trips only: fact and pickup dimension of the last
    version, joined; the version before stays whole beside it."""
    raw, root, suffix = lens.raw_trip_lens(spark, sf_dir), scratch_path(spark, "warehouse"), "_" + unique_name("run")
    built = warehouse.build_star(spark, raw, order_cols=lens.NATURAL_KEY)
    try:
        first = warehouse.load_star(built, suffix, root)
        kept = spark.table(first["FactTable"]).where("VendorID = 1").select("trip_id")
        # the second load keeps the first one's ids: its trips come from the same ranking, joined once for both tables
        whole = built.trips.select(*dict.fromkeys(star.FACT_COLUMNS + star.PICKUP_DIM_COLUMNS)).drop(star.PICKUP_ID, star.DROPOFF_ID)
        trips = star.with_location_ids(stage(whole.join(kept, "trip_id", "left_semi"), "switch"))
        tables = warehouse.star_set(spark, suffix, root)
        old = tables.names()
        version = tables.load({n: {"FactTable": star.fact_trips(trips), "PickupLocationsDim": star.pickup_location_dim(trips)}.get(n, spark.table(t))
                               for n, t in old.items()})
    finally:
        built.release()
    now = tables.names(version)
    return spark.table(now["FactTable"]).join(spark.table(now["PickupLocationsDim"]).drop("pickup_latitude"), "pickup_location_id").select(
        *star.FACT_COLUMNS, "pickup_longitude")


_DAMAGED = {"passenger_count": "l_linenumber % 3 = 0", "total_amount": "l_orderkey % 7 = 0"}


@register("load_step_counts", f"""
WITH {DATEKEYS_CTE}
SELECT 'landing' AS step, count(*) AS rows FROM lens
UNION ALL SELECT 'typed', count(*) FROM lens
UNION ALL SELECT 'FactTable', count(*) FROM lens
UNION ALL SELECT 'PaymentTypesDim', CAST(6 AS BIGINT)
UNION ALL SELECT 'PickupLocationsDim', count(*) FROM lens
UNION ALL SELECT 'DropOffLocationsDim', count(*) FROM lens
UNION ALL SELECT 'DateDim', count(*) FROM datekeys
UNION ALL SELECT 'RateCodesDim', CAST(6 AS BIGINT)
UNION ALL SELECT 'VendorsDim', CAST(2 AS BIGINT)
""" + "".join(f"UNION ALL SELECT 'nulled {c}', count(*) FROM lens WHERE {_DAMAGED.get(c, 'FALSE')}\n" for c in TRIP_COLUMNS))
def load_step_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows at each step of a load and values lost to their types, counted by the load itself."""
    raw = lens.raw_trip_lens(spark, sf_dir)
    for column, where in _DAMAGED.items():
        raw = raw.withColumn(column, F.when(F.expr(where), F.lit("n/a")).otherwise(F.col(column)))
    _, counts = warehouse.load_with_counts(spark, raw, "_" + unique_name("run"), scratch_path(spark, "warehouse"),
                                           order_cols=lens.NATURAL_KEY)
    return spark.createDataFrame(list(counts.items()), "step string, rows long")


@register("loaded_vendor_trip_counts", _ORACLES["vendor_trip_counts"])
def loaded_vendor_trip_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build + truncate-load the star, then count trips per vendor from the loaded tables."""
    return warehouse.build_load_analyse(
        spark, lens.raw_trip_lens(spark, sf_dir), "_" + unique_name("run"),
        scratch_path(spark, "warehouse"), order_cols=lens.NATURAL_KEY)


@register("surrogate_key_positions", """
SELECT count(*) AS n, count(*) AS n_distinct, CAST(1 AS BIGINT) AS first_id, count(*) AS last_id FROM lineitem
""")
def surrogate_key_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense ids in scan order, for trips without a natural key: 1..n whatever the splits."""
    trips = star.key_trips(lens.trip_lens(spark, sf_dir))
    return trips.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("trip_id").alias("n_distinct"),
                     F.min("trip_id").alias("first_id"), F.max("trip_id").alias("last_id"))


@register("loaded_payment_names", f"""
WITH {KEYED_CTE} SELECT k.trip_id AS trip_id, k.payment_type AS payment_type, p.payment_type_name AS payment_type_name
FROM keyed k LEFT JOIN ({PAYMENT_SQL}) p ON k.payment_type = p.payment_type
""")
def loaded_payment_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each loaded trip with the name of its payment type, from the loaded tables."""
    loaded = warehouse.build_and_load(spark, lens.trip_lens(spark, sf_dir), "_" + unique_name("run"),
                                      scratch_path(spark, "warehouse"), order_cols=lens.NATURAL_KEY)
    fact, names = spark.table(loaded["FactTable"]), spark.table(loaded["PaymentTypesDim"])
    return fact.join(names, "payment_type", "left").select("trip_id", "payment_type", "payment_type_name")


@register("loaded_trip_locations", f"WITH {KEYED_CTE} SELECT {ANALYSIS_SQL} FROM keyed")
def loaded_trip_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build + truncate-load the star (trip-keyed tables bucketed on their ids),
    then read the fact and both location dimensions back and join them."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    loaded = warehouse.build_and_load(spark, lens.trip_lens(spark, sf_dir), "_" + unique_name("run"),
                                      scratch_path(spark, "warehouse"), order_cols=lens.NATURAL_KEY, buckets=buckets)
    return warehouse.analyse_locations_loaded(spark, loaded)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
