"""Days and instants, always in UTC whatever the session's time zone."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
SECONDS_PER_DAY = 86400


def parse_day(text: Column, strict: bool = True) -> Column:
    """A `yyyy-MM-dd` text as a date. Bad text fails the job, or gives NULL when not strict."""
    day = text.try_cast("date")
    # The cast also takes other forms; only the one it prints itself is accepted.
    exact = F.when(day.cast("string") == text, day)
    if not strict:
        return exact
    return exact.when(text.isNotNull(), F.raise_error(F.concat(F.lit("not a yyyy-MM-dd date: "), text)))


def is_day_text(text: Column) -> Column:
    return text.rlike(DAY_SHAPE)


def utc_midnight(day: Column) -> Column:
    """The instant a UTC day begins."""
    return F.timestamp_seconds(F.unix_date(day).cast("long") * SECONDS_PER_DAY)


def utc_day(instant: Column, granularity: str = "day") -> Column:
    """The UTC day of an instant, or the first day of its month or year."""
    day = F.date_from_unix_date(F.floor(F.unix_seconds(instant) / SECONDS_PER_DAY).cast("int"))
    return day if granularity == "day" else F.trunc(day, granularity).cast("date")


def today_utc() -> date:
    return datetime.now(timezone.utc).date()


def yesterday(as_of: date | None = None) -> tuple[date, date]:
    """The daily window: yesterday, as start and end."""
    day = (as_of or today_utc()) - timedelta(days=1)
    return day, day


def look_back(as_of: date | None = None, days: int = 90) -> tuple[date, date]:
    """The window that ends yesterday and starts `days` before its end (both days included)."""
    end = (as_of or today_utc()) - timedelta(days=1)
    return end - timedelta(days=days), end


def as_day(value: date | str) -> date:
    """A window bound given as a date or as `yyyy-MM-dd` text."""
    if isinstance(value, datetime):
        raise ValueError(f"expected a day, got {value!r}")
    if isinstance(value, date):
        return value
    if not isinstance(value, str) or not re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", value):
        raise ValueError(f"expected yyyy-MM-dd, got {value!r}")
    return date.fromisoformat(value)
