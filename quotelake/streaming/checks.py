"""The checks of the history, kept by day as it grows.

A day's state is the number of its rows, the bad ones by check and its newest event
time. States add up, so a batch of new rows is merged into those of the days it touches,
and checks and freshness of all there is need no look at the history.

The merged states are staged under the number of the batch before any is replaced: a
batch that runs again after a failure only replaces them once more, and nothing counts
twice. The first batch of a checkpoint starts anew.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quotelake.config import LakeConfig
from quotelake.operators import check_states, is_in_days, merge_states, touched_days
from quotelake.operators.quality import CHECK_STATE_SCHEMA
from quotelake.schemas import SILVER_SCHEMA
from quotelake.sinks import replace_days, replace_table
from quotelake.sources import stream_table
from quotelake.streaming.triggers import trigger


def read_check_states(spark: SparkSession, config: LakeConfig) -> DataFrame:
    """One row a day; ``states_summary`` gives the checks of any days of them."""
    try:
        return spark.read.schema(CHECK_STATE_SCHEMA).parquet(config.check_states)
    except AnalysisException:
        return spark.createDataFrame([], CHECK_STATE_SCHEMA)


def _staged(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """What this batch staged in an earlier attempt, if it was wholly written."""
    try:
        staged = spark.read.parquet(path)
        own = staged.select("batch_id").first()
    except AnalysisException:
        return None
    return staged.drop("batch_id") if own is not None and own[0] == batch_id else None


def merge_batch(config: LakeConfig, batch: DataFrame, batch_id: int) -> None:
    """Merge the rows of a batch into the states of their days."""
    spark = batch.sparkSession
    new_path, merged_path = f"{config.check_staging}/batch", f"{config.check_staging}/merged"
    merged = None if batch_id == 0 else _staged(spark, merged_path, batch_id)
    if merged is None:
        replace_table(check_states(batch), new_path)
        new = spark.read.parquet(new_path)
        old = read_check_states(spark, config)
        if batch_id == 0:
            old = old.limit(0)
        else:
            # The days prune what is read; of those in between, the untouched are left out.
            touched = new.select(F.col("dt").alias("_dt"))
            old = old.where(is_in_days(touched_days(new)) | F.col("dt").isNull())
            old = old.join(touched, F.col("dt").eqNullSafe(F.col("_dt")), "left_semi")
        replace_table(merge_states(old, new).withColumn("batch_id", F.lit(batch_id)), merged_path)
        merged = spark.read.parquet(merged_path).drop("batch_id")
    if batch_id == 0:
        replace_table(merged, config.check_states, by_day=True)
    else:
        replace_days(merged, config.check_states)


def start_checks(spark: SparkSession, config: LakeConfig, *, available_now: bool = False) -> StreamingQuery:
    """Keep the check states of the history as it grows."""
    rows = stream_table(spark, config.history, SILVER_SCHEMA, files_per_batch=config.files_per_batch)
    return (
        rows.writeStream.foreachBatch(lambda batch, batch_id: merge_batch(config, batch, batch_id))
        .option("checkpointLocation", config.checkpoint("checks"))
        .trigger(**trigger(config, available_now))
        .start()
    )
