"""ISO-8601 text timestamps: the layer tables keep text, and parse it where a value is needed."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, functions as F

_ISO_LOCAL = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utc_now_iso() -> str:
    """Default run stamp; jobs take the stamp as a parameter so that reruns are repeatable."""
    return datetime.now(timezone.utc).isoformat()


def iso_utc(c: Column | str) -> Column:
    """UTC wall-clock timestamp -> ``yyyy-MM-ddTHH:mm:ss.SSSSSS+00:00``."""
    return F.concat(F.date_format(_col(c), _ISO_LOCAL), F.lit("+00:00"))


def iso_date(c: Column | str) -> Column:
    """Date part of an ISO text: its first ten characters."""
    return F.substring(_col(c), 1, 10)


def blank_to_null(c: Column | str) -> Column:
    """Unset timestamps are empty strings in the source system."""
    return F.nullif(_col(c), F.lit(""))


def parse_iso(c: Column | str) -> Column:
    """ISO text -> timestamp; unset or unreadable text -> null, never an ANSI error."""
    return F.try_to_timestamp(blank_to_null(c))


def is_iso(c: Column | str) -> Column:
    """Whether a text is an ISO-8601 date, or date and time, that exists; null for null."""
    return _col(c).rlike(r"^\d{4}-\d{2}-\d{2}([T ]|$)") & F.try_to_timestamp(_col(c)).isNotNull()


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Elapsed minutes (double) between two ISO texts."""
    return (F.unix_micros(parse_iso(end)) - F.unix_micros(parse_iso(start))) / F.lit(60_000_000.0)


def days_between(start: Column | str, end: Column | str) -> Column:
    """Midnights crossed between two ISO texts, independent of the session time zone."""
    return F.datediff(iso_date(end).try_cast("date"), iso_date(start).try_cast("date"))
