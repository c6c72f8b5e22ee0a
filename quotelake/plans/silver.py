"""Bronze to silver: history and latest."""

from __future__ import annotations

from pyspark.sql import SparkSession

from quotelake.config import LakeConfig
from quotelake.operators import latest_per_day
from quotelake.plans.days import day_jobs
from quotelake.schemas import SILVER_SCHEMA
from quotelake.sinks import replace_days
from quotelake.sources import read_table, stream_events
from quotelake.streaming.silver import start_history, start_latest, start_quarantine


def build_history(
    spark: SparkSession,
    config: LakeConfig,
    *,
    quarantine: bool = True,
    files_per_batch: int | None = None,
) -> None:
    """Take all new bronze files into history, and what it leaves out aside.

    The streams' checkpoints know what was taken in before: a second run adds
    nothing. ``files_per_batch`` cuts a first run over a large bronze into
    several commits. The quarantine reads the new files once more.
    """
    events = stream_events(
        spark,
        config.bronze,
        files_per_batch=files_per_batch or config.files_per_batch,
        integral_amounts=config.integral_amounts,
    )
    start_history(events, config, available_now=True).awaitTermination()
    if quarantine:
        start_quarantine(events, config, available_now=True).awaitTermination()


def build_latest(spark: SparkSession, config: LakeConfig) -> None:
    """The latest rows of every day of the history, made anew where the days lie."""
    for latest in day_jobs(read_table(spark, config.history, SILVER_SCHEMA), latest_per_day):
        replace_days(latest, config.latest, cluster=False)


def build_silver(
    spark: SparkSession,
    config: LakeConfig,
    *,
    quarantine: bool = True,
    files_per_batch: int | None = None,
) -> None:
    """``build_history``, then the latest rows, computed once after all commits."""
    build_history(spark, config, quarantine=quarantine, files_per_batch=files_per_batch)
    start_latest(spark, config, available_now=True).awaitTermination()
