"""faretrail: a Spark-native trip-analytics warehouse.

Landing trip records (CSV, Parquet, Hive-style partitions, JDBC tables, or
incrementally as files arrive) are coerced to typed columns, given stable
surrogate keys, split into a star schema (trip fact; vendor, payment-type,
rate-code, pickup-location, drop-off-location and date dimensions), loaded with
truncate-and-load semantics and analysed -- all as DataFrame / Spark SQL /
Structured Streaming plans.
"""

from faretrail.functions.coerce import lenient_double, lenient_int, lenient_timestamp, type_trips
from faretrail.functions.keys import dense_key, monotonic_key
from faretrail.operators.joins import join, join_on
from faretrail.operators.star import (date_dim, dropoff_location_dim, fact_trips, key_trips,
                                      pickup_location_dim)
from faretrail.plans.analysis import (rate_code_counts, trip_locations, trip_vendor,
                                      vendor_trip_counts)
from faretrail.plans.warehouse import (analyse_loaded, analyse_locations_loaded, build_star,
                                       load_star)
from faretrail.sinks.tables import truncate_load
from faretrail.sources.files import read_partitioned, read_trips_csv, read_trips_parquet
from faretrail.streaming.incremental import IncrementalStarLoader

__version__ = "0.1.0"

__all__ = [
    "lenient_int", "lenient_double", "lenient_timestamp", "type_trips",
    "dense_key", "monotonic_key", "join", "join_on",
    "key_trips", "fact_trips", "pickup_location_dim", "dropoff_location_dim", "date_dim",
    "vendor_trip_counts", "trip_vendor", "trip_locations", "rate_code_counts",
    "build_star", "load_star", "analyse_loaded", "analyse_locations_loaded",
    "truncate_load", "read_trips_csv", "read_trips_parquet", "read_partitioned",
    "IncrementalStarLoader",
]
