"""Gold by what a batch of new history changes.

Quotes lie in folders by day and, below, by a hash of the coin; they keep their lineage,
as it decides against quotes to come. A batch reads the folders it touches, ranks its rows
against the quotes there, and replaces those folders; the daily state of the touched days is
merged with sums of what was added and retracted. History is not read again.

Both results are staged, under the number of the batch, before anything is replaced. A
batch that runs again after a failure finds them and only replaces once more, so nothing
counts twice. The first batch of a checkpoint starts anew, whatever an earlier one left.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.config import LakeConfig
from quotelake.functions import lag_minutes
from quotelake.operators import (
    QualityError,
    added,
    coin_bucket,
    daily_changes,
    enforce_contract,
    in_days,
    last_day,
    merge_state,
    missing_columns,
    quality_failures,
    quality_metrics,
    rank_changes,
    state_metrics,
    touched_days,
)
from quotelake.operators.days import DayRange
from quotelake.operators.deltas import STATE_SCHEMA
from quotelake.schemas import SILVER_SCHEMA
from quotelake.session import shuffle_partitions
from quotelake.sinks import replace_folders, replace_table
from quotelake.sources import read_table


def _stored(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A table that is still to come has no rows."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def read_winners(spark: SparkSession, config: LakeConfig) -> DataFrame:
    """Published quotes with lineage and folder."""
    fields = [field for field in SILVER_SCHEMA if field.name != "dt"]
    days = [SILVER_SCHEMA["dt"], T.StructField("bucket", T.IntegerType())]
    return _stored(spark, config.quotes, T.StructType([*fields, *days]))


def read_state(spark: SparkSession, config: LakeConfig) -> DataFrame:
    return _stored(spark, config.daily_state, STATE_SCHEMA)


def _staged(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """What this batch staged in an earlier attempt, if it was wholly written."""
    try:
        staged = spark.read.parquet(path)
        own = staged.select("batch_id").first()
    except AnalysisException:
        return None
    return staged.drop("batch_id") if own is not None and own[0] == batch_id else None


def _stage(table: DataFrame, path: str, batch_id: int) -> DataFrame:
    replace_table(table.withColumn("batch_id", F.lit(batch_id)), path)
    return table.sparkSession.read.parquet(path).drop("batch_id")


def ranked_batch(config: LakeConfig, quotes: DataFrame, winners: DataFrame) -> DataFrame:
    """The batch against the winners of the folders it touches, with its ``bucket``."""
    own = quotes.withColumn("bucket", coin_bucket(config.delta_buckets))
    buckets = [row["bucket"] for row in own.select("bucket").distinct().collect()]
    old = in_days(winners, touched_days(quotes)).where(F.col("bucket").isin(buckets))
    # The folders prune what is read; of those, the ones that no row of the batch is in are left out.
    old = old.join(own.select("dt", "bucket").distinct(), ["dt", "bucket"], "left_semi")
    return rank_changes(old, quotes).withColumn("bucket", coin_bucket(config.delta_buckets))


def check_changes(
    config: LakeConfig, ranked: DataFrame, state: DataFrame, days: list[DayRange], as_of: Column | None
) -> int:
    """Number of quotes that the batch adds; ``QualityError`` if they are not fit.

    Those that are published already have passed. Freshness is that of all quotes:
    the newest is among those of the batch's days or on a later day.
    """
    counted = added(ranked).agg(F.count("*").alias("added"), *quality_metrics(config.reject_nan))
    summary = counted.first().asDict()
    many = summary.pop("added")
    last = last_day(days)
    later = state if last is None else state.where(F.col("dt") > F.lit(last))
    times = ranked.select(F.col("event_time_ts").alias("time")).union(later.select("last_time"))
    as_of = F.current_timestamp() if as_of is None else as_of
    newest = times.agg(F.max("time").alias("newest")).select("newest", lag_minutes(F.col("newest"), as_of).alias("lag")).first()
    summary |= {"newest_event_time": newest["newest"], "lag_minutes": newest["lag"]}
    reasons = quality_failures(summary, config.max_lag_minutes)
    if reasons:
        raise QualityError(reasons)
    return many


def _missing_in_history(spark: SparkSession, config: LakeConfig) -> list[str]:
    """Required columns the history lacks, as the one file tells that Spark opens for it."""
    try:
        return missing_columns(read_table(spark, config.history))
    except AnalysisException:
        raise
    except (PySparkException, Py4JJavaError):
        # An old file that cannot be read is not needed; a column that the batch lacks is
        # null in it, and fails the checks.
        return []


def publish_changes(batch: DataFrame, config: LakeConfig, batch_id: int, *, as_of: Column | None = None) -> None:
    """Bring quotes and daily metrics up to date with a batch of new history rows."""
    spark = batch.sparkSession
    missing = _missing_in_history(spark, config)
    if missing:
        raise QualityError([f"missing_columns:{missing}"])
    first = batch_id == 0
    with shuffle_partitions(spark, config.shuffle_partitions):
        ranked = None if first else _staged(spark, config.changes_staging, batch_id)
        known = spark.createDataFrame([], STATE_SCHEMA) if first else read_state(spark, config)
        if ranked is None:
            quotes, winners = enforce_contract(batch), read_winners(spark, config)
            ranked = ranked_batch(config, quotes, winners.limit(0) if first else winners)
            ranked = _stage(ranked, config.changes_staging, batch_id)
        days = touched_days(ranked)
        if not check_changes(config, ranked, known, days, as_of):
            return
        winners = ranked.where("place = 1").select(*SILVER_SCHEMA.fieldNames(), "bucket")
        state = None if first else _staged(spark, config.state_staging, batch_id)
        if state is None:
            merged = merge_state(in_days(known, days), daily_changes(ranked), winners)
            state = _stage(merged, config.state_staging, batch_id)
        for table, path, below in (
            (winners, config.quotes, ("bucket",)),
            (state, config.daily_state, ()),
            (state_metrics(state), config.daily, ()),
        ):
            replace_folders(table, path, *below, all_of_it=first)
