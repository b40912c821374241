"""Relational operators of the warehouse: star derivation, joins, counts, previews."""

from faretrail.operators.aggregates import grouped_count, grouped_count_sql, row_count
from faretrail.operators.joins import STRATEGIES, join, join_on, salted_join
from faretrail.operators.preview import partition_stats, print_preview
from faretrail.operators.preview import preview as preview_rows
from faretrail.operators.star import (date_dim, date_dim_dedup_rows, date_dim_prededup,
                                      dropoff_location_dim, fact_trips, key_trips,
                                      pickup_location_dim, union_timestamps,
                                      with_location_ids)

__all__ = [
    "grouped_count", "grouped_count_sql", "row_count", "STRATEGIES", "salted_join", "join",
    "join_on", "partition_stats", "preview_rows", "print_preview", "date_dim", "date_dim_dedup_rows",
    "date_dim_prededup", "dropoff_location_dim", "fact_trips", "key_trips",
    "pickup_location_dim", "union_timestamps", "with_location_ids",
]
