"""When a query runs: at each interval, or once over what is there now."""

from __future__ import annotations

from quotelake.config import LakeConfig


def trigger(
    config: LakeConfig, available_now: bool, seconds: int | None = None
) -> dict[str, object]:
    if available_now:
        return {"availableNow": True}
    return {"processingTime": f"{seconds or config.poll_seconds} seconds"}
