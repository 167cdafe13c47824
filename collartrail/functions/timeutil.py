"""Times are TIMESTAMP_NTZ holding UTC; nothing here depends on the session zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


# The two accepted layouts, as a pattern and as a parse format.
_ISO = (r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}", "yyyy-M-d'T'H:m:s")
_PLAIN = (r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}", "yyyy-M-d H:m:s")


def _parse(col: Column, layout: tuple[str, str]) -> Column:
    pattern, form = layout
    text = F.regexp_substr(col, F.lit(pattern))
    return F.try_to_timestamp(text, F.lit(form)).cast("timestamp_ntz")


def parse_iso(col: Column) -> Column:
    """``2024-01-28T15:00:38`` -> time; anything else -> NULL.

    Text after the seconds (a fraction, a ``Z``) is ignored.
    """
    return _parse(col, _ISO)


def parse_plain(col: Column) -> Column:
    """``2024-01-28 15:00:38`` -> time; anything else -> NULL. Text after it is ignored."""
    return _parse(col, _PLAIN)


def at(value: str | dt.datetime | Column) -> Column:
    """A time given as text (``T`` or blank between date and time), datetime or column."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def date_of(col: Column) -> Column:
    return F.to_date(col)


def hour_of(col: Column) -> Column:
    return F.hour(col)


def whole_seconds(col: Column) -> Column:
    """Seconds since 1970, fractions cut off."""
    days = F.date_diff(F.to_date(col), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(col) * 3600 + F.minute(col) * 60 + F.second(col)


def make_time(year, month, day, hour, minute, second) -> Column:
    """Time from parts; impossible or missing parts -> NULL."""
    return F.try_make_timestamp_ntz(year, month, day, hour, minute, second)


def hours(value) -> Column:
    """Duration; fractions of an hour are kept."""
    value = value if isinstance(value, Column) else F.lit(float(value))
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (value * 3600).cast("decimal(18,6)"))


def day_after(as_of: str | dt.date | None = None) -> Column:
    """Midnight after ``as_of`` (default: today)."""
    day = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    return F.date_add(day, 1).cast("timestamp_ntz")


def to_number(col: Column) -> Column:
    """Text to whole number; text that is none -> NULL."""
    return col.try_cast("int")


def to_day(col: Column) -> Column:
    return col.try_cast("date")


def hour_slot(date: Column, hour: Column) -> Column:
    """One whole number per (date, hour); -1 when both are missing, NULL when one is.

    Missing matches missing in the joins this key serves, hence -1.
    """
    days = F.date_diff(date, F.lit("1970-01-01").cast("date")).cast("bigint")
    return F.when(date.isNull() & hour.isNull(), F.lit(-1).cast("bigint")).otherwise(
        days * 24 + hour
    )


def approx_hour(hour: Column, minute: Column) -> Column:
    """Hour under which a late-evening video looks for its fix: 19:46-20:59 -> 21."""
    at_19 = hour.eqNullSafe(F.lit(19))
    moved = F.when(at_19 & (minute > 45), 21).when(~at_19 | (minute <= 45), hour)
    return F.when(hour.eqNullSafe(F.lit(20)), 21).otherwise(moved)
