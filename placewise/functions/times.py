"""Hour of day of an ISO-8601 time stamp."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hour_of_day(stamp: Column | str = "data.created_at", tz: str | None = "UTC") -> Column:
    """Hour 0-23 in ``tz``; null for an unreadable stamp.

    ``tz=None`` gives the hour in the session's zone. With a zone, stamps that carry
    their own zone give the same hour in every session (others are read in the session's): the shifted wall clock is read off the epoch seconds.
    """
    moment = F.try_to_timestamp(F.col(stamp) if isinstance(stamp, str) else stamp)
    if tz is None:
        return F.hour(moment)
    wall = F.unix_seconds(F.from_utc_timestamp(moment, tz))
    return F.floor(F.pmod(wall, F.lit(86400)) / 3600).cast("int")
