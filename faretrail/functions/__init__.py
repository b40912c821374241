"""Column-level functions: lenient coercion, date labels, surrogate keys."""

from faretrail.functions.coerce import (lenient_double, lenient_int,
                                        lenient_timestamp, type_trips)
from faretrail.functions.dates import date_labels, date_text
from faretrail.functions.keys import dense_key, monotonic_key, with_landing_position

__all__ = [
    "lenient_int", "lenient_double", "lenient_timestamp", "type_trips",
    "date_labels", "date_text", "dense_key", "monotonic_key", "with_landing_position",
]
