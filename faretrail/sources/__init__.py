"""Sources: trip lens over the driver tables, literal dims, files, JDBC."""

from faretrail.sources.files import (read_partitioned, read_trips_csv,
                                     register_partitioned_table,
                                     read_trips_parquet)
from faretrail.sources.jdbc import hash_predicates, read_jdbc
from faretrail.sources.lens import (NATURAL_KEY, as_landing_text, lens_sql, raw_trip_lens,
                                    table, trip_lens)
from faretrail.sources.literals import payment_type_dim, rate_code_dim, vendor_dim

__all__ = [
    "read_trips_csv", "read_trips_parquet", "read_partitioned",
    "register_partitioned_table",
    "read_jdbc", "hash_predicates", "NATURAL_KEY", "trip_lens", "raw_trip_lens",
    "as_landing_text", "lens_sql", "table", "payment_type_dim", "rate_code_dim", "vendor_dim",
]
