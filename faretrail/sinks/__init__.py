"""Sinks: Parquet / partitioned / CSV files and truncate-and-load tables."""

from faretrail.sinks.files import (csv_to_parquet, land_csv, land_csv_stamped, landing_order, stamped_name,
                                   with_day_partitions, write_parquet, write_partitioned)
from faretrail.sinks.tables import jdbc_truncate_load, stage, truncate_load

__all__ = [
    "csv_to_parquet", "land_csv", "land_csv_stamped", "landing_order", "stamped_name",
    "with_day_partitions", "write_parquet", "write_partitioned", "jdbc_truncate_load", "stage", "truncate_load",
]
