"""The lake as continuous queries, each with its own checkpoint."""

from quotelake.streaming.checks import read_check_states, start_checks
from quotelake.streaming.gold import start_gold, start_serving
from quotelake.streaming.ingest import (
    landed_records,
    poll_events,
    rejected_records,
    start_landing,
    start_polls,
    start_rejects,
)
from quotelake.streaming.lake import start_lake
from quotelake.streaming.runlog import RunLog, read_run_log, run_totals
from quotelake.streaming.silver import (
    refresh_latest,
    start_history,
    start_latest,
    start_quarantine,
)
from quotelake.streaming.snapshot import snapshot_rows, start_snapshot

__all__ = [
    "RunLog",
    "landed_records",
    "poll_events",
    "read_check_states",
    "read_run_log",
    "refresh_latest",
    "rejected_records",
    "run_totals",
    "snapshot_rows",
    "start_checks",
    "start_gold",
    "start_history",
    "start_lake",
    "start_landing",
    "start_latest",
    "start_polls",
    "start_quarantine",
    "start_rejects",
    "start_serving",
    "start_snapshot",
]
