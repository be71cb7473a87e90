"""Column expressions on timestamps and dates (all JVM built-ins).

Weekday conventions differ by input and are kept apart on purpose:
``weekday`` (Mon=0) for intraday features, ``dayofweek`` (Sun=1) for the
calendar feed, and the calendar table's own ``wday`` (Sat=1).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def state_of(store: Column | str) -> Column:
    """State from the store prefix: ``CA_1`` -> ``CA``."""
    return F.substring_index(_c(store), "_", 1)


def interval_5min(ts: Column | str) -> Column:
    """Index of the 5-minute slot within the day (0..287)."""
    t = _c(ts)
    return (F.hour(t) * 12 + F.floor(F.minute(t) / 5)).cast("int")


def interval_15min(interval5: Column | str) -> Column:
    """Index of the 15-minute slot from the 5-minute slot index."""
    return F.floor(_c(interval5) / 3).cast("int")


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def width_seconds(width: str | int) -> int:
    """``"15 minutes"`` -> 900; an int is taken as seconds."""
    if isinstance(width, int):
        return width
    m = re.fullmatch(r"\s*(\d+)\s*(second|minute|hour|day)s?\s*", width.lower())
    if not m:
        raise ValueError(f"unsupported bucket width {width!r}")
    return int(m.group(1)) * _UNIT_SECONDS[m.group(2)]


def bucket_start(ts: Column | str, width: str | int, dtype: T.DataType = T.TimestampNTZType()) -> Column:
    """Start of the epoch-aligned bucket of ``width`` holding ``ts``.

    Plain arithmetic, no ``window()``: a NULL timestamp gives a NULL bucket
    and the row is kept (``window()`` filters it out).  A zoned timestamp is
    floored on the instant, so the two passes through a repeated autumn hour
    stay apart; a zone-less timestamp is floored on its wall-clock fields,
    independent of the session time zone.
    """
    w = width_seconds(width)
    t = _c(ts)
    if isinstance(dtype, T.TimestampNTZType):
        day0 = t.cast("date")
        days = F.datediff(day0, F.lit("1970-01-01").cast("date")).cast("long")
        tod = F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
        secs = days * 86400 + tod
        # offset of the bucket start from midnight (negative when it starts the day before)
        offset = tod - F.pmod(secs, F.lit(w))
        return F.timestamp_add("SECOND", offset, day0.cast("timestamp_ntz"))
    us = F.unix_micros(t.cast("timestamp"))
    return F.timestamp_micros(us - F.pmod(us, F.lit(w * 1_000_000)))


def epoch_micros(ts: Column | str, dtype: T.DataType = T.TimestampNTZType()) -> Column:
    """Microseconds since 1970-01-01 00:00; zone-less input read as wall clock."""
    t = _c(ts)
    if isinstance(dtype, T.TimestampNTZType):
        days = F.datediff(t.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
        secs = days * 86400 + F.hour(t) * 3600 + F.minute(t) * 60
        frac = (F.date_part(F.lit("SECOND"), t) * 1_000_000).cast("long")
        return secs * 1_000_000 + frac
    return F.unix_micros(t.cast("timestamp"))


def parse_date(c: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    """ISO date string to date; unparseable input gives NULL, not an error."""
    return F.try_to_date(_c(c), fmt)


def parse_timestamp(c: Column | str, dtype: T.DataType) -> Column:
    """Parse a timestamp only when it arrives as a string."""
    if isinstance(dtype, T.StringType):
        return F.try_to_timestamp(_c(c))
    return _c(c)


def flag(cond: Column) -> Column:
    """Boolean condition as a 0/1 integer, NULL counted as 0."""
    return F.when(cond, 1).otherwise(0)


def hour_of_day(ts) -> Column:
    return F.hour(_c(ts))


def day_of_month(ts) -> Column:
    return F.dayofmonth(_c(ts))


def day_of_year(ts) -> Column:
    return F.dayofyear(_c(ts))


def week_of_year(ts) -> Column:
    return F.weekofyear(_c(ts))


def quarter(ts) -> Column:
    return F.quarter(_c(ts))


# Windowed calendar flags.
WEEKEND_MON0 = [5, 6]
MONTH_START_MAX_DAY = 3
MONTH_END_MIN_DAY = 28
QUARTER_START_MONTHS = [1, 4, 7, 10]
QUARTER_START_MAX_DAY = 7
QUARTER_END_MONTHS = [3, 6, 9, 12]
QUARTER_END_MIN_DAY = 24
BUSINESS_HOURS = (9, 17)


def calendar_feature_columns(ts: Column | str, day_of_week: Column | str, month: Column | str) -> dict[str, Column]:
    """The ten calendar features of a bucket timestamp (Mon=0 weekday input)."""
    t = _c(ts)
    dom = F.dayofmonth(t)
    m = _c(month)
    return {
        "hour_of_day": F.hour(t),
        "day_of_month": dom,
        "day_of_year": F.dayofyear(t),
        "week_of_year": F.weekofyear(t),
        "quarter": F.quarter(t),
        "is_weekend": flag(_c(day_of_week).isin(WEEKEND_MON0)),
        "is_month_start": flag(dom <= MONTH_START_MAX_DAY),
        "is_month_end": flag(dom >= MONTH_END_MIN_DAY),
        "is_quarter_start": flag(m.isin(QUARTER_START_MONTHS) & (dom <= QUARTER_START_MAX_DAY)),
        "is_quarter_end": flag(m.isin(QUARTER_END_MONTHS) & (dom >= QUARTER_END_MIN_DAY)),
    }


def is_business_hours(hour: Column | str) -> Column:
    lo, hi = BUSINESS_HOURS
    return flag(_c(hour).between(lo, hi))


def exact_month_start(d: Column | str) -> Column:
    return flag(F.dayofmonth(_c(d)) == 1)


def exact_month_end(d: Column | str) -> Column:
    return flag(_c(d) == F.last_day(_c(d)))
