"""Gold tables of the days that new history touches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quotelake.config import LakeConfig
from quotelake.operators import QualityError
from quotelake.operators.days import DayRange
from quotelake.plans.delta import publish_changes
from quotelake.plans.gold import build_snapshot, publish_quotes
from quotelake.schemas import SILVER_SCHEMA
from quotelake.sources import stream_table
from quotelake.streaming.silver import days_to_refresh, refresh_latest
from quotelake.streaming.triggers import trigger


def _publish(
    batch: DataFrame,
    batch_id: int,
    config: LakeConfig,
    days: list[DayRange] | None,
    as_of: Column | None,
    failures: list[QualityError] | None,
) -> None:
    """Gold of a batch, by what it changes or of its whole days."""
    try:
        if config.gold_write == "delta":
            publish_changes(batch, config, batch_id, as_of=as_of)
        else:
            # The batch's own session, which is not the one outside.
            publish_quotes(batch.sparkSession, config, days=days, as_of=as_of)
    except QualityError as failure:
        if failures is not None:
            failures.append(failure)
        raise


def start_gold(
    spark: SparkSession,
    config: LakeConfig,
    *,
    available_now: bool = False,
    every_seconds: int | None = None,
    as_of: Column | None = None,
    files_per_batch: int | None = None,
    failures: list[QualityError] | None = None,
) -> StreamingQuery:
    """Publish the quotes and daily metrics of touched days after their checks.

    A batch that fails its checks ends the query before anything of it is
    published; it is tried again at the next start, and its error is appended to
    ``failures``. Unless gold is kept by deltas, each batch recomputes its days from
    history, so its interval is longer than that of the polls.
    """

    def refresh(batch: DataFrame, batch_id: int) -> None:
        days = days_to_refresh(batch, batch_id)
        if days != []:
            _publish(batch, batch_id, config, days, as_of, failures)

    new_rows = stream_table(
        spark, config.history, SILVER_SCHEMA, files_per_batch=files_per_batch
    )
    return (
        (new_rows if config.gold_write == "delta" else new_rows.select("dt"))
        .writeStream.foreachBatch(refresh)
        .option("checkpointLocation", config.checkpoint("gold"))
        .trigger(**trigger(config, available_now, every_seconds or config.serve_seconds))
        .start()
    )


def start_serving(
    spark: SparkSession,
    config: LakeConfig,
    *,
    available_now: bool = False,
    every_seconds: int | None = None,
    as_of: Column | None = None,
    files_per_batch: int | None = None,
    failures: list[QualityError] | None = None,
) -> StreamingQuery:
    """Latest rows, quotes, daily metrics and snapshot in one query, in turn.

    The snapshot reads the latest rows, so one query has to do both: it would
    lose files under its hands if another replaced them.
    """

    def refresh(batch: DataFrame, batch_id: int) -> None:
        days = days_to_refresh(batch, batch_id)
        if days == []:
            return
        refresh_latest(config, batch, batch_id, days)
        _publish(batch, batch_id, config, days, as_of, failures)
        build_snapshot(batch.sparkSession, config)

    new_rows = stream_table(
        spark, config.history, SILVER_SCHEMA, files_per_batch=files_per_batch
    )
    return (
        new_rows.writeStream.foreachBatch(refresh)
        .option("checkpointLocation", config.checkpoint("serving"))
        .trigger(**trigger(config, available_now, every_seconds or config.serve_seconds))
        .start()
    )
