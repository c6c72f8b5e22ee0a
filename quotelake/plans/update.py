"""Gold, and all that is served, of the days that new history touches."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quotelake.config import LakeConfig
from quotelake.operators import QualityError
from quotelake.plans.gold import build_snapshot
from quotelake.streaming.gold import start_gold, start_serving


def update_gold(spark: SparkSession, config: LakeConfig, *, as_of: Column | None = None) -> None:
    """Publish quotes and daily metrics of touched days, then the snapshot.

    With nothing new, nothing is written. The first run takes all days.
    """
    failures: list[QualityError] = []
    if finish(start_gold(spark, config, available_now=True, as_of=as_of, failures=failures), failures):
        build_snapshot(spark, config)


def update_serving(spark: SparkSession, config: LakeConfig, *, as_of: Column | None = None) -> None:
    """``update_gold``, and the latest rows of the touched days before."""
    failures: list[QualityError] = []
    finish(start_serving(spark, config, available_now=True, as_of=as_of, failures=failures), failures)


def finish(query: StreamingQuery, failures: list[QualityError]) -> bool:
    """Wait for a run over what is there; whether it took anything in.

    A failed check, which the run left in ``failures``, is raised as itself.
    """
    try:
        query.awaitTermination()
    except StreamingQueryException as failure:
        if failures:
            raise failures[-1] from failure
        raise
    return any(progress["numInputRows"] for progress in query.recentProgress)
