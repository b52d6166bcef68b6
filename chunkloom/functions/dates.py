"""Times of job records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The zone that records are kept in, and its offset.
ZONE, OFFSET = "Asia/Kolkata", "+05:30"


def local_time(at: Column, offset: str = OFFSET) -> Column:
    """A timestamp as ISO text in a zone, to the second; null stays null."""
    return F.date_format(F.from_utc_timestamp(F.to_utc_timestamp(at, F.current_timezone()), offset), "yyyy-MM-dd'T'HH:mm:ss")


def elapsed(start: Column, end: Column) -> Column:
    """The time between two ISO texts as HH:MM:SS; hours run on beyond a day."""
    at = lambda c: F.unix_timestamp(F.to_timestamp(F.concat(c, F.lit("Z"))))  # noqa: E731  both in one zone, which need not be the session's
    seconds = at(end) - at(start)
    part = lambda c: F.when(c < 10, F.concat(F.lit("0"), c.cast("string"))).otherwise(c.cast("string"))
    return F.concat_ws(":", *[part(F.floor(c).cast("long")) for c in (seconds / 3600, F.pmod(seconds, F.lit(3600)) / 60, F.pmod(seconds, F.lit(60)))])
