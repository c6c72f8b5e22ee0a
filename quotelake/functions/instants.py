"""Instants: text to timestamp and back, and differences."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: ISO-8601 with microseconds and a numeric offset.
ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def parse_instant(text: Column | str) -> Column:
    """Timestamp of an ISO-8601 text; null when the text is not one."""
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text)


def iso_text(instant: Column) -> Column:
    return F.date_format(instant, ISO_PATTERN)


def utc_literal(moment: datetime) -> Column:
    """Timestamp literal that means the same instant in every session zone."""
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return F.to_timestamp(F.lit(moment.astimezone(timezone.utc).isoformat()))


def lag_minutes(instant: Column, as_of: Column) -> Column:
    """Minutes from ``instant`` to ``as_of``, exact to the microsecond."""
    return (F.unix_micros(as_of) - F.unix_micros(instant)) / F.lit(60e6)
