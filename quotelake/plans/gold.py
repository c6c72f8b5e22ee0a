"""Silver to gold: stage, check, publish.

The deduplicated quotes are written to a staging table in the layout of the
published one. Every key holds the day and the coin, and history lies by day: days are
deduplicated where they lie, without a shuffle, but for very large ones and packed
histories. The checks are taken as the rows are staged, so the gate needs no read of its
own, and nothing is published that was not checked. Publishing copies the staged quotes,
and the daily metrics read nine of their columns, both without a shuffle: two more reads,
one of them a whole copy, for that gate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import partial, reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.config import LakeConfig
from quotelake.functions import lag_minutes
from quotelake.operators import (
    QualityError,
    current_snapshot,
    cut_ranges,
    daily_metrics,
    day_ranges,
    dedup_quotes,
    enforce_contract,
    freshness,
    in_days,
    is_in_days,
    last_day,
    missing_columns,
    quality_failures,
    quality_metrics,
    sum_metrics,
    touched_days,
)
from quotelake.operators.days import DayRange
from quotelake.plans.compact import is_packed, read_history
from quotelake.plans.days import day_jobs
from quotelake.schemas import GOLD_QUOTES_SCHEMA, SILVER_SCHEMA
from quotelake.session import gathered_joins, shuffle_partitions
from quotelake.sinks import append_days, cluster_by_day, replace_days, replace_table
from quotelake.sources import read_table

Days = Sequence[DayRange] | None

# The snapshot shuffles so many rows whole: they are some 70 bytes each.
SHUFFLED_ROWS = 5_000_000
# The first columns that rank the rows of a coin, and with them the day they lie in.
LAST_TIMES = ("event_time_ts", "last_updated_ts")
LAST_TIMES_SCHEMA = T.StructType([SILVER_SCHEMA[c] for c in ("dt", "coin_id", *LAST_TIMES)])


def gold_quotes(history: DataFrame) -> DataFrame:
    """Deduplicated quotes of a history, with the columns of the fact table.

    Lineage goes through the deduplication, where it decides between ties.
    """
    return dedup_quotes(enforce_contract(history)).select(*GOLD_QUOTES_SCHEMA.fieldNames())


def stage_quotes(
    spark: SparkSession, config: LakeConfig, days: Days = None
) -> tuple[DataFrame, Mapping[str, object]]:
    """Write the deduplicated quotes to staging; what is staged, and its checks.

    ``days_per_job`` bounds each job: every key holds the day, so the days can
    be deduplicated one after another.
    """
    history = read_table(spark, config.history)
    missing = missing_columns(history)
    if missing:
        raise QualityError([f"missing_columns:{missing}"])

    packed = False
    listed = touched_days(history) if config.days_per_job and days is None else days
    if config.days_per_job and listed:
        wanted = [is_in_days(group) for group in cut_ranges(listed, config.days_per_job)]
        if days is None:
            # Rows without a day must reach the checks, too.
            wanted[0] = wanted[0] | F.col("dt").isNull()
        parts = [history.where(condition) for condition in wanted]
    else:
        packed = is_packed(spark, config)
        parts = [read_history(spark, config, days) if packed else in_days(history, days)]
    metrics = []
    for part in parts:
        # Packed files lie by run, not by day.
        for quotes in [cluster_by_day(gold_quotes(part))] if packed else day_jobs(part, gold_quotes):
            seen = Observation()
            # Behind the shuffles: a task that runs again there is not counted twice.
            quotes = quotes.observe(seen, *quality_metrics(config.reject_nan))
            if metrics:
                append_days(quotes, config.staging, cluster=False)
            else:
                replace_table(quotes, config.staging, by_day=True, cluster=False)
            metrics.append(seen.get)
    return read_table(spark, config.staging, GOLD_QUOTES_SCHEMA), sum_metrics(metrics)


def check_quotes(
    spark: SparkSession,
    config: LakeConfig,
    metrics: Mapping[str, object],
    days: Days = None,
    as_of: Column | None = None,
) -> None:
    """Raise ``QualityError`` with all reasons if the staged quotes are not fit."""
    summary = dict(metrics)
    if days is None:
        as_of = F.current_timestamp() if as_of is None else as_of
        newest = F.lit(summary["newest_event_time"]).cast("timestamp")
        summary["lag_minutes"] = spark.range(1).select(lag_minutes(newest, as_of)).first()[0]
    else:
        # Freshness is a property of the whole history, also when only old days
        # are touched; its newest event lies on the last touched day or later,
        # unless no row of the given days or a later one is there.
        history = read_table(spark, config.history)
        later = freshness(history.where(F.col("dt") >= F.lit(last_day(days))), as_of=as_of).first()
        if later["newest_event_time"] is None:
            later = freshness(history, as_of=as_of).first()
        summary.update(later.asDict())
    reasons = quality_failures(summary, config.max_lag_minutes)
    if reasons:
        raise QualityError(reasons)


def publish_quotes(
    spark: SparkSession,
    config: LakeConfig,
    *,
    days: Days = None,
    as_of: Column | None = None,
) -> None:
    """Publish the quotes and daily metrics of all days, or of the given ones."""
    write = append_days if config.gold_write == "append" else replace_days
    with shuffle_partitions(spark, config.shuffle_partitions):
        staged, metrics = stage_quotes(spark, config, days)
        check_quotes(spark, config, metrics, days, as_of)
        # Staging holds each day in few files already: no shuffle is needed here.
        write(staged, config.quotes, cluster=False)
        for daily in day_jobs(staged, partial(daily_metrics, unique_times=True)):
            write(daily, config.daily, cluster=False)


def build_snapshot(spark: SparkSession, config: LakeConfig) -> None:
    """Replace the snapshot by the last row per coin of the daily latest rows.

    Of many rows only those at the last times of their coin are shuffled, see ``_last_rows``.
    """
    latest = enforce_contract(read_table(spark, config.latest))
    count = latest.count()
    if count > SHUFFLED_ROWS:
        latest = _last_rows(spark, config, latest, count)
    replace_table(current_snapshot(latest).drop("dt"), config.snapshot)


def _last_rows(spark: SparkSession, config: LakeConfig, latest: DataFrame, count: int) -> DataFrame:
    """The rows of ``latest`` at the last times of their coin, or all ``count`` if those are most.

    When and on which day a coin was last seen is found from four narrow columns. The rows
    of these days and times are then taken where their days lie, without a shuffle. Several
    of a coin may tie in time: what ranks them further is left to ``current_snapshot``.
    """
    times, rows = f"{config.snapshot_staging}-times", f"{config.snapshot_staging}-rows"
    order = [F.col(c).desc_nulls_last() for c in LAST_TIMES]
    place = F.rank().over(W.partitionBy("coin_id").orderBy(*order))
    ranked = latest.select("dt", "coin_id", *LAST_TIMES).withColumn("_rank", place)
    replace_table(ranked.where(F.col("_rank") == 1).drop("_rank"), times, by_day=True)
    last = read_table(spark, times, LAST_TIMES_SCHEMA)
    if last.count() > count // 2:
        return latest
    with gathered_joins(spark):
        for number, part in enumerate(day_jobs(latest, _at_times, last)):
            if number:
                append_days(part, rows, cluster=False)
            else:
                replace_table(part, rows, by_day=True, cluster=False)
    return read_table(spark, rows, latest.schema)


def _at_times(latest: DataFrame, last: DataFrame) -> DataFrame:
    # Spark would move a semi-join below the gathering in one partition, and shuffle.
    last = last.distinct()
    same = [latest[c].eqNullSafe(last[c]) for c in last.columns]
    # A hash of the few rows: neither side is sorted, and no table goes through the driver.
    return latest.join(last.hint("shuffle_hash"), reduce(and_, same)).select(*[latest[c] for c in latest.columns])


def build_gold(
    spark: SparkSession,
    config: LakeConfig,
    *,
    days: Sequence[date] | None = None,
    as_of: Column | None = None,
) -> None:
    """Publish quotes, daily metrics and snapshot, or nothing if a check fails.

    All days are made anew, or the given ones; no days, nothing to do.
    ``update_gold`` takes only those that new history touches.
    """
    if days is not None and not days:
        return
    if config.gold_write == "delta":
        raise ValueError("gold of this lake is kept by deltas: update_gold takes in what is new")
    publish_quotes(spark, config, days=None if days is None else day_ranges(days), as_of=as_of)
    build_snapshot(spark, config)
