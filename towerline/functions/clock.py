"""Time: UTC instants for storage, a fixed reporting offset for days and weeks."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Reporting clock is UTC+7 without summer time; weeks start on Monday.
REPORT_OFFSET_HOURS = 7
GRANULARITIES = ("15m", "hour", "day", "week")


def floor_minutes(ts: Column, minutes: int) -> Column:
    """Start of the period of `minutes` (a divisor of 60) that holds an instant."""
    start = F.date_trunc("hour", ts)
    step = (F.floor(F.minute(ts) / minutes) * minutes).cast("int")
    return start + F.make_dt_interval(mins=step)


def report_day(ts: Column) -> Column:
    return (ts + F.expr(f"INTERVAL {REPORT_OFFSET_HOURS} HOURS")).cast("date")


def report_week(ts: Column) -> Column:
    return F.date_trunc("week", report_day(ts)).cast("date")


def bucket(ts: Column, granularity: str) -> Column:
    """Quarter hours and hours stay in UTC; days and weeks follow the reporting clock."""
    if granularity == "15m":
        return floor_minutes(ts, 15)
    if granularity == "hour":
        return F.date_trunc("hour", ts)
    if granularity == "day":
        return report_day(ts)
    if granularity == "week":
        return report_week(ts)
    raise ValueError(f"unknown granularity {granularity}")


def periods_expected(granularity: str, minutes: int = 15) -> int:
    return {"15m": 15, "hour": 60, "day": 1440, "week": 10080}[granularity] // minutes


def window_of(first: date, last: date) -> dict[str, object]:
    """UTC days [first, last] -> the reporting days and weeks that they touch, with the UTC
    bounds needed to rebuild whole days and weeks (half open)."""
    lo = datetime.combine(first, datetime.min.time())
    hi = datetime.combine(last, datetime.min.time()) + timedelta(days=1)
    shift = timedelta(hours=REPORT_OFFSET_HOURS)
    day_first, day_last = (lo + shift).date(), (hi + shift - timedelta(microseconds=1)).date()
    week_first = day_first - timedelta(days=day_first.weekday())
    week_last = day_last - timedelta(days=day_last.weekday())
    at = lambda d: datetime.combine(d, datetime.min.time()) - shift
    return {
        "day_first": day_first, "day_last": day_last, "week_first": week_first, "week_last": week_last,
        "day_lo": at(day_first), "day_hi": at(day_last + timedelta(days=1)),
        "week_lo": at(week_first), "week_hi": at(week_last + timedelta(days=7)),
    }


def to_utc(text: Column) -> Column:
    """'2026-01-05T00:15:00+07:00' or '...+00:00:00' -> instant (null if malformed)."""
    return F.try_to_timestamp(F.regexp_replace(text, r"([+-]\d\d:\d\d):\d\d$", "$1"))


def check_range(lo: datetime, hi: datetime, most_days: int = 31) -> None:
    """Arguments of a range read: end after start, at most `most_days` long."""
    if hi <= lo:
        raise ValueError("end must be after start")
    if hi - lo > timedelta(days=most_days):
        raise ValueError(f"at most {most_days} days")


def check_week(day: date) -> None:
    if day.weekday() != 0:
        raise ValueError("a week starts on a Monday")
