"""Date parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_FORMAT = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z"


def parse_ts(c: Column) -> Column:
    """Parse ``yyyy-MM-dd HH:mm:ss`` strictly; any other shape, a signed year or an impossible date is NULL.

    The text names no time zone, so the result is ``timestamp_ntz``: the hour of a post is the
    hour that was written, whatever the session's zone. The pattern check also spares the
    parser the empty and malformed values.
    """
    return F.when(c.rlike(SECONDS_FORMAT), c.try_cast("timestamp_ntz"))
