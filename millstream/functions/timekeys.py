"""Date keys, shift calendars, business dates."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from millstream.functions.wallclock import col


def as_ntz(value) -> Column:
    """Literal wall-clock time from a datetime or text; Columns pass through."""
    if isinstance(value, Column):
        return value
    text = value.strftime("%Y-%m-%d %H:%M:%S.%f") if isinstance(value, dt.datetime) else str(value)
    return F.lit(text).cast("timestamp_ntz")


def interval(text: str) -> Column:
    return F.expr(f"interval {text}")


def date_key_range(key: str | Column) -> tuple[Column, Column]:
    """Half-open [start, end) of a key yyyy, yyyyMM, yyyy-MM, yyyyMMdd, yyyy-MM-dd or an ISO time (to the hour,
    minute or second it names). Unreadable keys give nulls."""
    key = F.trim(col(key))
    size = F.length(key)
    day = (
        F.when(size == 4, F.try_to_date(key, "yyyy"))
        .when(size == 6, F.try_to_date(key, "yyyyMM"))
        .when(size == 7, F.try_to_date(key, "yyyy-MM"))
        .when(size == 8, F.try_to_date(key, "yyyyMMdd"))
        .when(size == 10, F.try_to_date(key, "yyyy-MM-dd"))
    )
    iso = F.translate(key, "T", " ")
    exact = (
        F.when(size == 13, F.concat(iso, F.lit(":00:00"))).when(size == 16, F.concat(iso, F.lit(":00"))).otherwise(iso)
    ).try_cast("timestamp_ntz")
    step = (
        F.when(size == 4, F.add_months(day, 12))
        .when(size.isin(6, 7), F.add_months(day, 1))
        .otherwise(F.date_add(day, 1))
        .cast("timestamp_ntz")
    )
    exact_end = (
        F.when(size == 13, exact + interval("1 hour"))
        .when(size == 16, exact + interval("1 minute"))
        .otherwise(exact + interval("1 second"))
    )
    long_key = size > 10
    return F.when(long_key, exact).otherwise(day.cast("timestamp_ntz")), F.when(long_key, exact_end).otherwise(step)


def today_slice(ts: str | Column, as_of, src_tz: str | None = None, dst_tz: str | None = None) -> Column:
    """Rows of the local day that holds `as_of`; zones convert `as_of` before the day is cut."""
    now = as_ntz(as_of)
    if src_tz and dst_tz:
        now = F.convert_timezone(F.lit(src_tz), F.lit(dst_tz), now)
    day = now.cast("date")
    ts = col(ts)
    return (ts >= day.cast("timestamp_ntz")) & (ts < F.date_add(day, 1).cast("timestamp_ntz"))


def last_3_months(as_of: dt.date) -> list[str]:
    """yyyymm of the day and of 30 and 60 days before it."""
    return [(as_of - dt.timedelta(days=30 * back)).strftime("%Y%m") for back in range(3)]


def last_3_months_filter(ym: str | Column, as_of: dt.date) -> Column:
    return col(ym).isin(last_3_months(as_of))


@dataclass(frozen=True)
class Shift:
    number: int
    start: str
    end: str


# Shift starts and ends per weekday (1 = Monday). The night shift that starts at 22:30 ends at
# 06:30 next day. Two calendars are in use: Friday's second shift ends 22:30 in one and 23:00 in the other.
WEEKDAY_SHIFTS = [Shift(1, "06:30", "14:30"), Shift(2, "14:30", "22:30"), Shift(3, "22:30", "06:30")]
FRIDAY_SHIFTS = [Shift(1, "06:30", "15:00"), Shift(2, "15:00", "22:30"), Shift(3, "22:30", "06:30")]
FRIDAY_LATE_SHIFTS = [Shift(1, "06:30", "15:00"), Shift(2, "15:00", "23:00"), Shift(3, "23:00", "06:30")]
SATURDAY_SHIFTS = [Shift(1, "06:30", "11:30"), Shift(2, "11:30", "16:30"), Shift(3, "16:30", "21:30")]

CALENDARS = {
    "cycle": {"weekday": WEEKDAY_SHIFTS, "friday": FRIDAY_SHIFTS, "saturday": SATURDAY_SHIFTS},
    "productivity": {"weekday": WEEKDAY_SHIFTS, "friday": FRIDAY_LATE_SHIFTS, "saturday": SATURDAY_SHIFTS},
}
DAY_START = "06:30"


def _minute(text: str) -> int:
    hours, minutes = text.split(":")
    return int(hours) * 60 + int(minutes)


def _minute_of_day(ts: Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def shift_of_timestamp(ts: str | Column, calendar: str = "cycle") -> Column:
    """Shift number 1, 2 or 3, or null outside working hours.

    Before 06:30 the reading belongs to the night shift of the previous day, Monday to Friday only.
    """
    ts = col(ts)
    at = _minute_of_day(ts)
    weekday = F.weekday(ts)
    days = CALENDARS[calendar]

    def by_end(shifts: list[Shift]) -> Column:
        chain = F.when(F.lit(False), F.lit(0))
        for s in shifts:
            end = _minute(s.end)
            chain = chain.when(at < end, s.number) if end > _minute(s.start) else chain.otherwise(s.number)
        return chain

    early = at < _minute(DAY_START)
    return (
        F.when(early, F.when(F.pmod(weekday - 1, F.lit(7)) <= 4, 3))
        .when(weekday <= 3, by_end(days["weekday"]))
        .when(weekday == 4, by_end(days["friday"]))
        .when(weekday == 5, by_end(days["saturday"]))
    )


def shift_window(ts: str | Column) -> tuple[Column, Column, Column]:
    """(start, end, business date) of the productivity shift running at `ts`; null when none runs.

    Follows the productivity calendar with its Friday quirk: from 23:00 on the shift starts at 22:30, so it
    overlaps the late second shift. Saturday before 06:30 and Sunday have no shift; after 16:30 on Saturday the
    third shift is reported until midnight although it ends at 21:30. Without a shift the business date is the day itself.
    """
    ts = col(ts)
    at = _minute_of_day(ts)
    weekday = F.weekday(ts)
    midnight = F.date_trunc("day", ts).cast("timestamp_ntz")

    def since(text: str, days: int = 0) -> Column:
        return midnight + F.make_dt_interval(F.lit(days), F.lit(0), F.lit(_minute(text)), F.lit(0).cast("decimal(18,6)"))

    night_before = since("22:30", -1)
    weekday_start = (
        F.when(at < _minute("06:30"), night_before)
        .when(at < _minute("14:30"), since("06:30"))
        .when(at < _minute("22:30"), since("14:30"))
        .otherwise(since("22:30"))
    )
    friday_start = (
        F.when(at < _minute("06:30"), night_before)
        .when(at < _minute("15:00"), since("06:30"))
        .when(at < _minute("23:00"), since("15:00"))
        .otherwise(since("22:30"))
    )
    saturday_start = (
        F.when(at < _minute("06:30"), F.lit(None))
        .when(at < _minute("11:30"), since("06:30"))
        .when(at < _minute("16:30"), since("11:30"))
        .otherwise(since("16:30"))
    )
    start = F.when(weekday <= 3, weekday_start).when(weekday == 4, friday_start).when(weekday == 5, saturday_start)
    # Length is read off the start time alone, so a Saturday first shift is also given eight hours.
    short = (_minute_of_day(start)).isin(_minute("11:30"), _minute("16:30"))
    end = F.when(short, start + interval("5 hours")).otherwise(start + interval("8 hours"))
    return start, end, F.coalesce(start, ts).cast("date")


def business_date(ts: str | Column, cutoff: str = "6 hours") -> Column:
    """Working date: times before the cutoff belong to the previous day."""
    return (col(ts) - interval(cutoff)).cast("date")


def business_date_pair(ts: str | Column, cutoff: str = "6 hours") -> tuple[Column, Column]:
    """(date for shift 1, date for shifts 2 and 3)."""
    day = business_date(ts, cutoff)
    return F.date_sub(day, 1), day


def month_start(ts: str | Column) -> Column:
    return F.trunc(col(ts).cast("date"), "MM")
