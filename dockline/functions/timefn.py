"""Time, ratio and calendar helpers."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_instant(s) -> Column:
    """ISO-8601 text (with or without offset) -> instant (``timestamp``).
    ``try_cast`` because ANSI mode makes a plain cast throw on bad text."""
    return _c(s).try_cast("timestamp")


def to_ntz(ts) -> Column:
    """Instant -> wall-clock UTC ``timestamp_ntz`` (session zone is UTC)."""
    return _c(ts).cast("timestamp_ntz")


def iso_utc(ts) -> Column:
    """Instant -> ISO text with microseconds and a ``+00:00`` offset."""
    return F.date_format(_c(ts).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def occupancy_ratio(bikes="num_bikes_available", docks="num_docks_available") -> Column:
    """bikes / NULLIF(bikes + docks, 0) as double."""
    b, d = _c(bikes).cast("double"), _c(docks).cast("double")
    return b / F.nullif(b + d, F.lit(0.0))


def hour_of_day(ts) -> Column:
    return F.hour(_c(ts))


def weekday_monday0(ts) -> Column:
    """Day of week with Monday = 0 (``weekday``, not ``dayofweek``)."""
    return F.weekday(_c(ts))


def minutes_between(later, earlier) -> Column:
    """(later - earlier) in minutes as double, exact to the microsecond."""
    return (F.unix_micros(_c(later).cast("timestamp")) - F.unix_micros(_c(earlier).cast("timestamp"))) / F.lit(60_000_000.0)
