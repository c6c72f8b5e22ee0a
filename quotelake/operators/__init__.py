"""Operators from DataFrame to DataFrame.

None starts a job but ``touched_days``, and ``ranked_page`` for a deep page without keys.
"""

from quotelake.operators.clean import (
    clean_events,
    parse_events,
    quarantined_events,
    tag_events,
)
from quotelake.operators.contract import enforce_contract
from quotelake.operators.days import (
    cut_ranges,
    day_ranges,
    in_days,
    is_in_days,
    last_day,
    touched_days,
)
from quotelake.operators.deltas import (
    added,
    coin_bucket,
    daily_changes,
    daily_state,
    merge_state,
    rank_changes,
    state_metrics,
)
from quotelake.operators.drift import record_fields, schema_drift
from quotelake.operators.events import count_by_run, filter_ids, keyed_json, pages_to_events
from quotelake.operators.latest import (
    current_snapshot,
    dedup_quotes,
    keep_latest,
    latest_per_day,
    ranked_page,
)
from quotelake.operators.metrics import daily_metrics
from quotelake.operators.quality import (
    QualityError,
    check_states,
    freshness,
    merge_states,
    missing_columns,
    quality_failures,
    quality_metrics,
    quality_report,
    quality_summary,
    states_summary,
    sum_metrics,
)

__all__ = [
    "QualityError",
    "added",
    "check_states",
    "clean_events",
    "coin_bucket",
    "count_by_run",
    "current_snapshot",
    "cut_ranges",
    "daily_changes",
    "daily_metrics",
    "daily_state",
    "day_ranges",
    "dedup_quotes",
    "enforce_contract",
    "filter_ids",
    "freshness",
    "in_days",
    "is_in_days",
    "keep_latest",
    "keyed_json",
    "last_day",
    "latest_per_day",
    "merge_state",
    "merge_states",
    "missing_columns",
    "pages_to_events",
    "parse_events",
    "quality_failures",
    "quality_metrics",
    "quality_report",
    "quality_summary",
    "quarantined_events",
    "rank_changes",
    "ranked_page",
    "record_fields",
    "schema_drift",
    "state_metrics",
    "states_summary",
    "sum_metrics",
    "tag_events",
    "touched_days",
]
