"""Dates and the calendar."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# National holidays as month * 100 + day.
HOLIDAYS = (101, 501, 907, 1012, 1102, 1115, 1225)

# Fixed value: the key given to an order whose day is not in the calendar.
UNKNOWN_DATE_KEY = 19000101


def as_moment(now: datetime | date | str | Column | None) -> Column:
    """A point in time as a Column; ``None`` means the start of the query."""
    if now is None:
        return F.current_timestamp()
    if isinstance(now, Column):
        return now
    return F.lit(str(now)).cast("timestamp")


def parsed_timestamp(c: Column, date_format: str | Sequence[str | None] | None = None) -> Column:
    """NULL instead of an error for text that is no date. Of several formats the first one that the text fits wins; None is ISO 8601."""
    formats = [date_format] if date_format is None or isinstance(date_format, str) else list(date_format)
    if not formats:
        raise ValueError("no format to read dates by")
    return F.coalesce(*[F.try_to_timestamp(c) if f is None else F.try_to_timestamp(c, F.lit(f)) for f in formats])


def date_key(c: Column) -> Column:
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def is_holiday(c: Column) -> Column:
    return (F.month(c) * 100 + F.dayofmonth(c)).isin(*HOLIDAYS)


def age_hours(latest: Column, now: Column) -> Column:
    micros = F.unix_micros(now.cast("timestamp")) - F.unix_micros(latest.cast("timestamp"))
    return micros.cast("double") / F.lit(3.6e9)
