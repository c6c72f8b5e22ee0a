"""Raw events to history, and history to the latest rows, incrementally."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quotelake.config import LakeConfig
from quotelake.operators import (
    clean_events,
    in_days,
    latest_per_day,
    quarantined_events,
    touched_days,
)
from quotelake.operators.days import DayRange
from quotelake.schemas import SILVER_SCHEMA
from quotelake.sinks.tables import cluster_by_day, replace_days, replace_table
from quotelake.sources import read_table, stream_table
from quotelake.streaming.triggers import trigger


def start_history(
    events: DataFrame,
    config: LakeConfig,
    *,
    available_now: bool = False,
    cluster: bool | None = None,
) -> StreamingQuery:
    """Append each raw file once to the history, however often this is started.

    Late rows land in their own day: there is no watermark that could drop them.
    Without ``cluster`` (by default as configured) nothing is shuffled, and each
    task writes a file for each day it meets: for a first load of large files.
    """
    cleaned = clean_events(events)
    if config.integral_amounts:
        # The history goes on in the type it has.
        amounts = ("market_cap_usd", "total_volume_usd")
        cleaned = cleaned.withColumns({name: F.col(name).try_cast("long") for name in amounts})
    cluster = config.cluster_history if cluster is None else cluster
    return (
        (cluster_by_day(cleaned) if cluster else cleaned)
        .observe("history", F.count(F.lit(1)).alias("kept"))
        .writeStream.format("parquet")
        .partitionBy("dt")
        .option("path", config.history)
        .option("checkpointLocation", config.checkpoint("history"))
        .trigger(**trigger(config, available_now))
        .start()
    )


def start_quarantine(
    events: DataFrame, config: LakeConfig, *, available_now: bool = False
) -> StreamingQuery:
    """Keep the records that the history leaves out."""
    return (
        quarantined_events(events)
        .observe("quarantine", F.count(F.lit(1)).alias("quarantined"))
        .writeStream.format("parquet")
        .option("path", config.quarantine)
        .option("checkpointLocation", config.checkpoint("quarantine"))
        .trigger(**trigger(config, available_now))
        .start()
    )


def days_to_refresh(batch: DataFrame, batch_id: int) -> list[DayRange] | None:
    """Days a micro-batch touches; None, for all days, in the first batch.

    The first batch holds all there was at the start, and a micro-batch is
    always read with all its columns: looking for its days would be one more
    pass over everything.
    """
    return None if batch_id == 0 else touched_days(batch)


def refresh_latest(
    config: LakeConfig,
    batch: DataFrame,
    batch_id: int,
    days: list[DayRange] | None,
) -> None:
    """Bring the latest rows of ``days``, which ``batch`` touches, up to date.

    The batch is merged with the old latest rows of those days, one per coin,
    by way of a staging table that carries the batch id. Staging that is absent
    or not older than this batch means that an earlier attempt may have been
    cut off while it replaced days: then the days are made from history.
    """
    spark = batch.sparkSession
    staged_id = None if days is None else _staged_batch(spark, config.latest_staging)
    if staged_id is not None and staged_id < batch_id:
        old = in_days(read_table(spark, config.latest, SILVER_SCHEMA), days)
        rows = batch.select(*SILVER_SCHEMA.fieldNames()).unionByName(old)
    else:
        rows = in_days(read_table(spark, config.history, SILVER_SCHEMA), days)
    merged = latest_per_day(rows).withColumn("batch_id", F.lit(batch_id))
    replace_table(merged, config.latest_staging)
    staged = spark.read.parquet(config.latest_staging)
    replace_days(staged.select(*SILVER_SCHEMA.fieldNames()), config.latest)


def _staged_batch(spark: SparkSession, path: str) -> int | None:
    try:
        return spark.read.parquet(path).agg(F.max("batch_id")).first()[0]
    except AnalysisException:
        return None


def start_latest(
    spark: SparkSession,
    config: LakeConfig,
    *,
    available_now: bool = False,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Keep the latest row of each coin and day as the history grows."""

    def refresh(batch: DataFrame, batch_id: int) -> None:
        days = days_to_refresh(batch, batch_id)
        if days != []:
            refresh_latest(config, batch, batch_id, days)

    new_rows = stream_table(
        spark, config.history, SILVER_SCHEMA, files_per_batch=files_per_batch
    )
    return (
        new_rows.writeStream.foreachBatch(refresh)
        .option("checkpointLocation", config.checkpoint("latest"))
        .trigger(**trigger(config, available_now))
        .start()
    )
