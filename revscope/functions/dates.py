"""Date expressions.

Review timestamps are Unix epoch milliseconds.  ``timestamp_millis`` keeps
the conversion in codegen (no string formatting round trip); with the session
time zone pinned to UTC the day and month edges are the UTC ones.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def review_timestamp(ts="timestamp") -> Column:
    """Epoch milliseconds -> TIMESTAMP, cut to whole seconds."""
    return F.timestamp_seconds(F.floor(_col(ts) / 1000))


def review_date(ts="timestamp") -> Column:
    """Epoch milliseconds -> DATE."""
    return F.to_date(F.timestamp_millis(_col(ts)))


def year_month(date="review_date") -> Column:
    """First day of the month as a DATE."""
    return F.trunc(_col(date), "month")


def span_days(first="first_review_date", last="last_review_date") -> Column:
    """Whole days between two dates."""
    return F.datediff(_col(last), _col(first))
