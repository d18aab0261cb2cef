"""Local-time and ``requested_at`` column functions.

Stored times are naive local wall-clock at a fixed UTC offset (default
+08:00) -> TIMESTAMP_NTZ. ``requested_at`` arrives either as ISO-8601 with
offset (worker form) or as an HTTP date (spider form); ``parse_requested_at``
turns both into one UTC wall-clock TIMESTAMP_NTZ so both profiles can share a
table. Every writer takes ``as_of`` so results are reproducible.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: default local offset in hours
DEFAULT_OFFSET_HOURS = 8


def offset_str(hours: int = DEFAULT_OFFSET_HOURS) -> str:
    sign = "+" if hours >= 0 else "-"
    return f"{sign}{abs(hours):02d}:00"


def local_now(as_of: str | None = None, offset_hours: int = DEFAULT_OFFSET_HOURS) -> _dt.datetime:
    """Naive local time: ``as_of`` (a UTC instant, ISO text) or now."""
    if as_of:
        t = _dt.datetime.fromisoformat(as_of)
        t = t.replace(tzinfo=_dt.timezone.utc) if t.tzinfo is None else t
    else:
        t = _dt.datetime.now(_dt.timezone.utc)
    return t.astimezone(_dt.timezone(_dt.timedelta(hours=offset_hours))).replace(tzinfo=None)


def local_now_literal(as_of: str | None = None, offset_hours: int = DEFAULT_OFFSET_HOURS) -> Column:
    return F.lit(local_now(as_of, offset_hours)).cast("timestamp_ntz")


def to_local(utc_wall: Column, offset_hours: int = DEFAULT_OFFSET_HOURS) -> Column:
    """UTC wall-clock TIMESTAMP_NTZ -> local wall-clock TIMESTAMP_NTZ."""
    return F.convert_timezone(F.lit("UTC"), F.lit(offset_str(offset_hours)),
                              utc_wall.cast("timestamp_ntz"))


def iso_with_offset(local_wall: Column, offset_hours: int = DEFAULT_OFFSET_HOURS) -> Column:
    """Python ``isoformat()`` of an aware local time: micros only when non-zero."""
    base = F.date_format(local_wall, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(local_wall, "SSSSSS")
    return F.concat(base, F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(F.lit("")),
                    F.lit(offset_str(offset_hours)))


def http_date(utc_wall: Column) -> Column:
    """RFC 1123 date as an HTTP ``Date`` header carries it."""
    return F.date_format(utc_wall, "EEE, dd MMM yyyy HH:mm:ss 'GMT'")


def parse_requested_at(text: Column) -> Column:
    """ISO-8601 with offset, or an HTTP date -> UTC wall-clock TIMESTAMP_NTZ."""
    iso = F.try_to_timestamp(text)
    # the weekday cannot be parsed by pattern; drop "Mon, " and read the rest
    rest = F.regexp_replace(text, r"^\s*[A-Za-z]{3},\s*", "")
    http = F.try_to_timestamp(rest, F.lit("dd MMM yyyy HH:mm:ss z"))
    instant = F.coalesce(iso, http)
    # instant -> wall clock in the session zone -> wall clock in UTC
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))
