"""Date arithmetic on timestamps without a zone, so no session time zone takes part."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(ts: Column) -> Column:
    return F.trunc(ts, "MM")


def day_of_week(ts: Column) -> Column:
    """Sunday is 0."""
    return F.dayofweek(ts) - 1


def whole_days(start: Column, end: Column) -> Column:
    """Full days that lie between, cut toward zero."""
    return F.extract(F.lit("DAY"), end - start)


def nearest_days(start: Column, end: Column) -> Column:
    """Elapsed time as the nearest number of days; an exact half goes away from zero."""
    half = F.expr("interval '12' hour")
    elapsed = end - start
    return F.extract(F.lit("DAY"), F.when(end >= start, elapsed + half).otherwise(elapsed - half))


def moment(as_of: datetime | None) -> Column:
    """``as_of``, or the start of the query when it is None."""
    if as_of is None:
        return F.localtimestamp()
    # As text: a datetime literal would be read in the time zone of this process.
    return F.lit(str(as_of)).cast("timestamp_ntz")
