"""Date/time column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from attrition.functions import values as V


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_yyyymmdd(c: Column | str) -> Column:
    """`20230901` (int or string) -> date; null for text that does not parse."""
    return F.try_to_date(_c(c).cast("string"), V.HIT_DATE_FORMAT)


def as_timestamp(c: Column | str) -> Column:
    """Normalise timestamp, timestamp_ntz or timestamp text to TIMESTAMP (bad text -> null)."""
    return _c(c).try_cast("timestamp")


def as_date(c: Column | str) -> Column:
    return _c(c).try_cast("date")


def hit_timestamp(date: Column | str, hour: Column | str, minute: Column | str,
                  mode: str = "compat") -> Column:
    """Minute-resolution hit time rendered as text.

    ``compat`` reproduces the upstream rendering: the minute is parsed through
    the seconds field and the hour is printed on a 12-hour clock, so 15:42
    becomes ``03:42`` and 00:05 becomes ``12:05``. ``exact`` keeps the 24-hour
    clock. Missing or malformed parts give null.
    """
    hh = F.format_string("%02d", _c(hour).try_cast("int"))
    mm = F.format_string("%02d", _c(minute).try_cast("int"))
    if mode == "compat":
        parsed = F.try_to_timestamp(F.concat(_c(date).cast("string"), hh, mm), F.lit(V.HIT_PARSE_FORMAT))
        return F.date_format(parsed, V.HIT_RENDER_FORMAT)
    if mode == "exact":
        parsed = F.try_to_timestamp(F.concat_ws(" ", _c(date).cast("string"), F.concat_ws(":", hh, mm)),
                                    F.lit("yyyy-MM-dd HH:mm"))
        return F.date_format(parsed, V.HIT_RENDER_FORMAT_EXACT)
    raise ValueError(f"unknown mode {mode!r}")


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Whole-second difference in minutes, rounded half-up to 2 decimals."""
    return F.round((_c(end).cast("long") - _c(start).cast("long")) / 60, 2)
