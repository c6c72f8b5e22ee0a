"""Readers of quote pages, raw events and lake tables, batch and streaming."""

from quotelake.sources.files import (
    read_events,
    read_pages,
    read_table,
    stream_events,
    stream_pages,
    stream_table,
)
from quotelake.sources.lines import event_rows
from quotelake.sources.topic import decode_events, read_topic, stream_topic, topic_options

__all__ = [
    "decode_events",
    "event_rows",
    "read_events",
    "read_pages",
    "read_table",
    "read_topic",
    "stream_events",
    "stream_pages",
    "stream_table",
    "stream_topic",
    "topic_options",
]
