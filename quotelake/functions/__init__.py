"""Column expressions; each is a composition of built-in functions."""

from quotelake.functions.instants import iso_text, lag_minutes, parse_instant, utc_literal
from quotelake.functions.records import event_json, is_json, record_key

__all__ = [
    "event_json",
    "is_json",
    "iso_text",
    "lag_minutes",
    "parse_instant",
    "record_key",
    "utc_literal",
]
