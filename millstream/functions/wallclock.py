"""Wall-clock arithmetic that ignores the session time zone.

Readings carry naive local time. Casting them to an instant would make the result depend on
the session zone (and break order in a daylight-saving gap), so epoch numbers are built from
calendar fields.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def width_seconds(width: str) -> float:
    """'10 minutes' -> 600. Months and years have no fixed width and are refused."""
    total = 0.0
    parts = width.split()
    for number, unit in zip(parts[::2], parts[1::2], strict=True):
        total += float(number) * UNIT_SECONDS[unit.rstrip("s")]
    return total


def width_months(width: str) -> int | None:
    """'3 months' -> 3, '1 year' -> 12; None for widths of fixed length."""
    number, unit = (width.split() + [""])[:2]
    per = {"month": 1, "year": 12}.get(unit.rstrip("s"))
    return int(number) * per if per else None


def width_us(width: str) -> int:
    return round(width_seconds(width) * 1_000_000)


def wall_seconds(ts: str | Column) -> Column:
    """Whole seconds since 1970-01-01 00:00 on the same wall clock."""
    ts = col(ts)
    day = F.unix_date(ts.cast("date")).cast("long")
    return day * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def wall_us(ts: str | Column) -> Column:
    """Microseconds since 1970-01-01 00:00 on the same wall clock."""
    ts = col(ts)
    day = F.unix_date(ts.cast("date")).cast("long")
    minutes = day * 1440 + F.hour(ts) * 60 + F.minute(ts)
    fraction = (F.date_part(F.lit("SECOND"), ts) * F.lit(1_000_000)).cast("long")
    return minutes * 60_000_000 + fraction


def us_to_ntz(us: Column) -> Column:
    """Inverse of `wall_us`."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    days = F.floor(us / F.lit(86_400_000_000)).cast("int")
    rest = us - days.cast("long") * F.lit(86_400_000_000)
    return origin + F.make_dt_interval(days, F.lit(0), F.lit(0), (rest / F.lit(1_000_000)).cast("decimal(18,6)"))


def seconds_between(earlier: str | Column, later: str | Column) -> Column:
    return (wall_us(later) - wall_us(earlier)) / F.lit(1_000_000.0)


def bucket_no(ts: str | Column, width: str) -> Column:
    """Number of the time bucket that holds `ts`; buckets of months follow the calendar."""
    if months := width_months(width):
        return F.floor((F.year(col(ts)) * 12 + F.month(col(ts)) - 1) / F.lit(months)).cast("long")
    seconds = width_seconds(width)
    if seconds == int(seconds):
        return F.floor(wall_seconds(ts) / F.lit(int(seconds))).cast("long")
    return F.floor(wall_us(ts) / F.lit(width_us(width))).cast("long")


def bucket_begin(number: Column, width: str) -> Column:
    """Start of the bucket with this number."""
    if months := width_months(width):
        first = number * F.lit(months)
        year, month = F.floor(first / 12).cast("int"), (F.pmod(first, F.lit(12)) + 1).cast("int")
        return F.make_timestamp_ntz(year, month, F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    return us_to_ntz(number * F.lit(width_us(width)))


def bucket_start(ts: str | Column, width: str) -> Column:
    """Start of the time bucket that holds `ts`."""
    return bucket_begin(bucket_no(ts, width), width)
