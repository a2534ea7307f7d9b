"""Wall-clock columns. The zone is always a parameter, never the host's or the session's."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Text formats of the alert records.
DAY_TIME = "dd/MM/yyyy HH:mm:ss"
MONTH_TIME = "MMM dd HH:mm:ss"
TIME_ONLY = "HH:mm:ss"
HOUR_MINUTE = "HH:mm"
DAY = "dd/MM/yyyy"


def utc_clock(ms: Column) -> Column:
    """Epoch milliseconds -> zone-less UTC timestamp."""
    return F.timestamp_add("MILLISECOND", ms, F.expr("timestamp_ntz'1970-01-01 00:00:00'"))


def wall_clock(ms: Column, tz: str = "UTC") -> Column:
    """Epoch milliseconds -> zone-less local timestamp."""
    return utc_clock(ms) if tz == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(tz), utc_clock(ms))


def trade_date(ms: Column, tz: str = "UTC") -> Column:
    return F.to_date(wall_clock(ms, tz))


def clock_text(ms: Column, fmt: str = DAY_TIME, tz: str = "UTC") -> Column:
    return F.date_format(wall_clock(ms, tz), fmt)


def at_or_after(ms: Column, hhmm: str, tz: str = "UTC") -> Column:
    """`HH:mm` comparison of the local time with a lock time such as 09:30."""
    return clock_text(ms, HOUR_MINUTE, tz) >= F.lit(hhmm)
