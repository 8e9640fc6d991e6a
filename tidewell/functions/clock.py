"""Time helpers. Wall-clock values are TIMESTAMP_NTZ throughout."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

EVENT_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
ISO_OFFSET_FORMAT = "yyyy-MM-dd'T'HH:mm:ssXXX"

# ISO date-time with an offset. Group 1 is the wall clock down to milliseconds.
_OFFSET_TEXT = (
    r"(?i)^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(?::\d{2}(?:\.\d{1,3})?)?)\d{0,6}"
    r"(?:Z|[+-](?:0\d|1[0-8]):[0-5]\d(?::[0-5]\d)?)$"
)


def wall_literal(moment: dt.datetime) -> Column:
    """A wall-clock constant. It goes through text: a datetime literal would be moved by the
    session zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def event_ts(col: Column) -> Column:
    """Event text with up to nine fractional digits to TIMESTAMP_NTZ; digits past six are cut."""
    return F.regexp_replace(col, r"(\.\d{6})\d+$", "$1").cast("timestamp_ntz")


def parse_event_ts(col: Column) -> Column:
    """Event text with exactly six fractional digits to an instant."""
    return F.to_timestamp(col, EVENT_TS_FORMAT)


def iso_offset(ts: Column) -> Column:
    """Instant as text with the session offset, to the second."""
    return F.date_format(ts, ISO_OFFSET_FORMAT)


def iso_offset_micros(ts: Column) -> Column:
    """Instant as text with the session offset, to the microsecond."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def wall_clock(text: Column) -> Column:
    """Local time of an ISO text with offset, cut to milliseconds; the offset is dropped.

    NULL stays NULL. Text without an offset, or that is no date, fails the query.
    """
    # Text that does not match gives an empty local part, which is no timestamp.
    local = F.upper(F.regexp_extract(text, _OFFSET_TEXT, 1)).try_cast("timestamp_ntz")
    bad = F.raise_error(F.concat(F.lit("not a date-time with offset: "), text))
    return F.when(text.isNotNull(), F.coalesce(local, bad.cast("timestamp_ntz")))


def on_day(ts: Column, day: str | dt.date) -> Column:
    """Rows of one day as a half-open range, which a scan can push down."""
    day = dt.date.fromisoformat(day) if isinstance(day, str) else day
    start = wall_literal(dt.datetime.combine(day, dt.time()))
    end = wall_literal(dt.datetime.combine(day + dt.timedelta(days=1), dt.time()))
    return (ts >= start) & (ts < end)


EPOCH = dt.datetime(1970, 1, 1)


def _interval_micros(interval: Column) -> Column:
    """A day-time interval in microseconds."""
    seconds = (
        F.extract(F.lit("DAY"), interval) * 86400
        + F.extract(F.lit("HOUR"), interval).cast("long") * 3600
        + F.extract(F.lit("MINUTE"), interval).cast("long") * 60
    )
    fraction = F.extract(F.lit("SECOND"), interval) * 1_000_000
    return seconds.cast("long") * 1_000_000 + fraction.cast("long")


def micros(ts: Column) -> Column:
    """Microseconds since 1970. Wall-clock values are counted without a zone, so they keep their
    order where a zone's clock jumps."""
    return _interval_micros(ts - wall_literal(EPOCH))


def from_seconds(seconds: Column) -> Column:
    """The wall-clock time so many seconds after 1970 began."""
    return F.timestamp_add("SECOND", seconds, wall_literal(EPOCH))


def duration_seconds(start: Column, end: Column) -> Column:
    """Seconds from start to end, with fractions; NULL if either is missing."""
    return _interval_micros(end - start) / F.lit(1e6)


def add_days(ts: Column, days: Column) -> Column:
    """``ts`` plus whole days, keeping the time of day."""
    return ts + F.make_dt_interval(days=days.cast("int"))


def add_hours(ts: Column, hours: Column) -> Column:
    return ts + F.make_dt_interval(hours=hours.cast("int"))


def cycling_date(key: Column, start: str, days: int) -> Column:
    """Date that walks through ``days`` days from ``start`` as the key grows."""
    return F.date_add(F.lit(start).cast("date"), F.pmod(key, F.lit(days)).cast("int"))
