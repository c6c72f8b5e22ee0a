"""Writers of lake tables, raw files and topics."""

from quotelake.sinks.tables import (
    append_days,
    append_days_for_lookup,
    cluster_by_day,
    replace_days,
    replace_folders,
    replace_table,
    save_bucketed,
)
from quotelake.sinks.topic import publish_stream, publish_topic

__all__ = [
    "append_days",
    "append_days_for_lookup",
    "cluster_by_day",
    "publish_stream",
    "publish_topic",
    "replace_days",
    "replace_folders",
    "replace_table",
    "save_bucketed",
]
