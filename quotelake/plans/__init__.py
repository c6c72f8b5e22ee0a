"""Whole runs over what a lake holds now."""

from quotelake.plans.compact import compact_history, read_history
from quotelake.plans.gold import build_gold, build_snapshot, publish_quotes, stage_quotes
from quotelake.plans.lake import build_lake
from quotelake.plans.ranks import RankIndex, indexed_page, write_rank_index
from quotelake.plans.silver import build_latest, build_silver
from quotelake.plans.update import update_gold, update_serving

__all__ = [
    "RankIndex",
    "build_gold",
    "build_lake",
    "build_latest",
    "build_silver",
    "build_snapshot",
    "compact_history",
    "indexed_page",
    "publish_quotes",
    "read_history",
    "stage_quotes",
    "update_gold",
    "update_serving",
    "write_rank_index",
]
