"""Lenient casts: what cannot be read becomes NULL instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(value: Column, dtype: str = "double") -> Column:
    return value.try_cast(dtype)


def to_timestamp(value: Column) -> Column:
    """Text as a timestamp without a zone.

    Takes ISO dates and date-times, and day-first ones (``31/12/2024``). A date-time
    with an offset or Z becomes the same moment in UTC. A bare year or month is not
    a date, though a plain cast would take it for one.
    """
    # The usual form first: it needs one match in place of three, and means the same below.
    usual = value.rlike(r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}:\d{2}(\.\d+)?)?$")
    text = F.trim(F.regexp_replace(value, r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})(?!\d)", "$3-$2-$1"))
    dated = F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}(?!\d)"), text)
    zone = r"(?i)(\d{1,2}:\d{2}.*?)\s*(Z|UTC|[+-]\d{2}(?::?\d{2})?)$"
    with_colon = F.regexp_replace(dated, r"([+-]\d{2})(\d{2})$", "$1:$2")
    other = F.when(dated.rlike(zone), at_utc(with_colon.try_cast("timestamp"))).otherwise(dated.try_cast("timestamp_ntz"))
    return F.when(usual, value.try_cast("timestamp_ntz")).otherwise(other)


def at_utc(moment: Column) -> Column:
    """A moment as the timestamp without a zone that clocks show in UTC, whatever the session's zone is."""
    start = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(moment), start)
