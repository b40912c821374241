"""Calendar labels of the date dimension.

Timestamps are zone-less (``timestamp_ntz``).  Day-level labels are formatted
from the day (``to_date``, a pure truncation), never from the timestamp
itself: formatting goes through the session time zone, and a wall-clock time
inside a daylight-saving gap would otherwise shift.  The day is the same in
every zone, so the labels are too.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_TIME_FIELDS = re.compile(r"[HhmsSakKn]")


def date_labels(datekey: str = "datekey") -> list[Column]:
    """Day, 2- and 4-digit year text and full month name of a timestamp key."""
    day = F.to_date(F.col(datekey))
    return [
        day.alias("date"),
        F.date_format(day, "yy").alias("year_yy"),
        F.date_format(day, "y").alias("year_yyyy"),
        F.date_format(day, "MMMM").alias("month"),
    ]


def date_text(c: str, fmt: str = "yyyy-MM-dd") -> Column:
    """Formatted text of a timestamp, e.g. ``2024-05-05``.  Formats with no
    time-of-day field are taken from the day, independent of the session zone."""
    src = F.col(c)
    quoted_free = re.sub(r"'[^']*'", "", fmt)
    return F.date_format(src if _TIME_FIELDS.search(quoted_free) else F.to_date(src), fmt)
