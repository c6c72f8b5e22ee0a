"""One query per operator: (session, folder of the given tables) to DataFrame.

Every query reads its tables whole. Sinks and streams write below a new
scratch path and return what they read back from it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake import operators as ops
from quotelake import plans
from quotelake.config import LakeConfig
from quotelake.functions import record_key, utc_literal
from quotelake.operators.quality import BAD_PRICE
from quotelake.plans import build_gold, build_lake, build_latest, build_silver
from quotelake.plans.compact import live_files
from quotelake.plans.gold import gold_quotes
from quotelake.schemas import (
    BRONZE_SCHEMA,
    CORRUPT_RECORD,
    GOLD_DAILY_SCHEMA,
    GOLD_QUOTES_SCHEMA,
    PAGE_SCHEMA,
    REQUIRED_COLUMNS,
    SILVER_SCHEMA,
)
from quotelake.session import scratch_path
from quotelake.sinks import append_days, append_days_for_lookup, replace_days, replace_table, save_bucketed
from quotelake.sources import (
    decode_events,
    read_events,
    read_pages,
    read_table,
    stream_events,
    stream_pages,
)
from quotelake.streaming import (
    RunLog,
    read_check_states,
    read_run_log,
    run_totals,
    start_checks,
    start_gold,
    start_history,
    start_landing,
    start_latest,
    start_polls,
    start_quarantine,
    start_rejects,
    start_snapshot,
)
from suite import tables as t

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime(2024, 2, 15, tzinfo=timezone.utc)
MAX_LAG_MINUTES = 20000
SPLIT_DAY = date(2024, 1, 16)
LISTED_IDS = ["click", "purchase"]
LISTED_PARTS = ["7", "21", "133", "no such part"]

# Silver columns whose values are the same in every run.
SILVER_VALUES = [
    c for c in SILVER_SCHEMA.fieldNames() if c not in ("ingestion_time", "source_file")
]


def _lake(spark: SparkSession, label: str) -> LakeConfig:
    # The given tables are of 2024: their age is no fault of a run.
    return LakeConfig(root=scratch_path(spark, label), max_lag_minutes=10**9)


def _rounded(daily: DataFrame) -> DataFrame:
    """Averages of doubles depend on the order of addition in their last digits."""
    return daily.withColumn("avg_price_usd", F.round("avg_price_usd", 6))


def _silver(quotes: DataFrame) -> DataFrame:
    return quotes.select(*SILVER_SCHEMA.fieldNames())


def _values(quotes: DataFrame) -> DataFrame:
    return t.comparable(quotes.select(*SILVER_VALUES))


# Sources


def src_api_page_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "pages") + "/pages"
    t.write_pages(spark, sf_dir, path)
    return read_pages(spark, path).select(*PAGE_SCHEMA.fieldNames())


def src_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lines") + "/bronze"
    t.write_lines(t.topic_records(spark, sf_dir, faulty=True, partial=True), path)
    return read_events(spark, path, ingested_at=AS_OF).select(
        *BRONZE_SCHEMA.fieldNames(),
        F.col(CORRUPT_RECORD).isNotNull().alias("is_corrupt"),
        F.col("source_file").contains("/bronze/partition=").alias("has_source_file"),
        F.col("ingestion_time").cast("timestamp_ntz").alias("ingestion_time"),
    )


def src_parquet_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "table") + "/history"
    append_days(_silver(t.event_quotes(spark, sf_dir)), path)
    return _values(read_table(spark, path, SILVER_SCHEMA))


def src_parquet_long_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history whose amounts earlier deployments wrote as longs."""
    path = scratch_path(spark, "longs") + "/history"
    amounts = {c: F.col(c).cast("long") for c in ("market_cap_usd", "total_volume_usd")}
    append_days(_silver(t.event_quotes(spark, sf_dir)).withColumns(amounts), path)
    return _values(read_table(spark, path, SILVER_SCHEMA))


def src_topic_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = t.topic_records(spark, sf_dir, faulty=True)
    return decode_events(records).select(*BRONZE_SCHEMA.fieldNames(), "source_file")


# Projections and filters


def norm_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.pages_to_events(
        t.api_objects(spark, sf_dir),
        poll_time=F.col("event_time_ts"),
        run_id=F.col("ingestion_run_id"),
        source="events",
        vs_currency="usd",
    )


def norm_record_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    event_id = F.col("event_id")
    gaps = t.event_quotes(spark, sf_dir).withColumns(
        {
            "coin_id": F.when(event_id % 7 == 0, "")
            .when(event_id % 5 != 0, F.col("coin_id")),
            "symbol": F.when(event_id % 2 == 0, "").when(event_id % 3 != 0, F.col("symbol")),
        }
    )
    return gaps.select("event_id", record_key(F.col("coin_id"), F.col("symbol")).alias("key"))


def filter_id_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _values(ops.filter_ids(t.event_quotes(spark, sf_dir), LISTED_IDS))


def filter_id_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = t.table(spark, sf_dir, "part").where(F.col("p_size") <= 10)
    ids = parts.select(F.col("p_partkey").cast("string").alias("coin_id"))
    return _values(ops.filter_ids(t.line_quotes(spark, sf_dir), ids))


def topn_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = ops.ranked_page(
        t.event_quotes(spark, sf_dir),
        [F.desc("market_cap_usd"), F.desc("last_updated_ts")],
        page=2,
        per_page=5,
        keys=["dt"],
    )
    return _values(page)


def topn_page_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.desc("market_cap_usd"), F.desc("last_updated_ts")]
    return _values(ops.ranked_page(t.event_quotes(spark, sf_dir), order, page=3, per_page=50))


def topn_page_global_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page behind the ranks that one task sorts, without keys."""
    order = [F.desc("price_usd")]
    return _values(ops.ranked_page(t.line_quotes(spark, sf_dir), order, page=500, per_page=50))


def topn_page_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deep pages of one kept ranking."""
    path = scratch_path(spark, "ranks") + "/by_price"
    index = plans.write_rank_index(t.line_quotes(spark, sf_dir), [F.desc("price_usd")], path)
    pages = [
        _values(plans.indexed_page(spark, index, page=number, per_page=50)).withColumn("page", F.lit(number).cast("long"))
        for number in (2, 500)
    ]
    return pages[0].union(pages[1])


def topn_page_indexed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``topn_page_deep`` from a kept ranking of each coin."""
    path = scratch_path(spark, "ranks") + "/of_coins"
    order = [F.desc("price_usd"), F.desc("last_updated_ts")]
    index = plans.write_rank_index(t.event_quotes(spark, sf_dir), order, path, ["coin_id"])
    return _values(plans.indexed_page(spark, index, page=24, per_page=50))


def topn_page_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four pages of a ranking with fifty values: together every row once."""
    quotes = t.line_quotes(spark, sf_dir)
    per_page = -(-quotes.count() // 4)
    pages = [
        _values(
            ops.ranked_page(quotes, [F.desc("market_cap_usd")], page=number, per_page=per_page)
        ).withColumn("page", F.lit(number).cast("long"))
        for number in range(1, 5)
    ]
    return pages[0].union(pages[1]).union(pages[2]).union(pages[3])


def topn_page_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page behind the first thousand ranks of each coin."""
    page = ops.ranked_page(
        t.event_quotes(spark, sf_dir),
        [F.desc("price_usd"), F.desc("last_updated_ts")],
        page=24,
        per_page=50,
        keys=["coin_id"],
    )
    return _values(page)


def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = t.topic_records(spark, sf_dir, faulty=True)
    return _values(ops.clean_events(decode_events(records)))


def quarantine_bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = t.topic_records(spark, sf_dir, faulty=True, partial=True)
    dropped = ops.quarantined_events(decode_events(records))
    return dropped.select(
        "reason",
        F.when(F.col("reason") == "unreadable", F.col("record"))
        .otherwise(F.get_json_object("record", "$.last_updated"))
        .alias("detail"),
    )


def tag_bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = t.topic_records(spark, sf_dir, faulty=True, partial=True)
    tagged = ops.tag_events(decode_events(records))
    return tagged.groupBy("status").agg(F.count(F.lit(1)).alias("records"))


def contract_enforce(spark: SparkSession, sf_dir: str) -> DataFrame:
    event_id = F.col("event_id")
    quotes = t.event_quotes(spark, sf_dir)
    texts = quotes.select(
        *[F.col(c).cast("string").alias(c) for c in SILVER_SCHEMA.fieldNames()],
        event_id,
    ).withColumns(
        {
            "price_usd": F.when(event_id % 83 == 0, "n/a").otherwise(F.col("price_usd")),
            "market_cap_rank": F.when(event_id % 89 == 0, "first").otherwise(
                F.col("market_cap_rank")
            ),
            "unknown_column": event_id,
        }
    )
    texts = texts.drop("event_id")
    return t.comparable(ops.enforce_contract(texts).drop("ingestion_time"))


# Ranking and aggregation


def silver_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _values(ops.latest_per_day(_silver(t.event_quotes(spark, sf_dir))))


def silver_latest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _values(ops.latest_per_day(_silver(t.line_quotes(spark, sf_dir))))


def dedup_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _values(ops.dedup_quotes(_silver(t.event_quotes(spark, sf_dir))))


def dedup_quotes_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _values(ops.dedup_quotes(_silver(t.line_quotes(spark, sf_dir))))


def gold_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = ops.latest_per_day(_silver(t.event_quotes(spark, sf_dir)))
    return _values(ops.current_snapshot(latest))


def gold_snapshot_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _values(ops.current_snapshot(_silver(t.line_quotes(spark, sf_dir))))


def daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    quotes = ops.dedup_quotes(_silver(t.event_quotes(spark, sf_dir)))
    return _rounded(ops.daily_metrics(quotes, unique_times=True))


def daily_metrics_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    quotes = ops.dedup_quotes(_silver(t.line_quotes(spark, sf_dir)))
    return _rounded(ops.daily_metrics(quotes, unique_times=True))


def daily_metrics_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics over quotes that share event times: the greater price is the last."""
    return _rounded(ops.daily_metrics(t.event_quotes(spark, sf_dir)))


def run_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.count_by_run(t.event_quotes(spark, sf_dir))


# Quality


def _faulty_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    event_id = F.col("event_id")
    return (
        t.event_quotes(spark, sf_dir)
        .withColumns(
            {
                "symbol": F.when(event_id % 11 != 0, F.col("symbol")),
                "market_cap_usd": F.when(event_id % 13 != 0, F.col("market_cap_usd")),
                "price_usd": F.when(event_id % 17 == 0, -F.col("price_usd")).when(
                    event_id % 19 != 0, F.col("price_usd")
                ),
            }
        )
    )


def _faulty_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.dedup_quotes(_faulty_history(spark, sf_dir).drop("event_id"))


def dq_required_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    quotes = t.event_quotes(spark, sf_dir).drop("symbol", "total_volume_usd")
    missing = ops.missing_columns(quotes)
    checks = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.lit(c in missing).alias("is_missing"))
            for c in REQUIRED_COLUMNS
        ]
    )
    counted = quotes.agg(F.count(F.lit(1)).alias("checked_rows"))
    return counted.select(F.inline(checks), "checked_rows")


def dq_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = ops.quality_report(_faulty_quotes(spark, sf_dir))
    return report.where(F.col("check_name").startswith("null_"))


def dq_price_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = ops.quality_report(_faulty_quotes(spark, sf_dir))
    return report.where(~F.col("check_name").startswith("null_"))


def dq_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    quotes = ops.dedup_quotes(_silver(t.event_quotes(spark, sf_dir)))
    fresh = ops.freshness(quotes, as_of=utc_literal(AS_OF))
    return t.comparable(
        fresh.withColumn("is_stale", F.col("lag_minutes") > MAX_LAG_MINUTES)
    )


def dq_gate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = ops.quality_summary(_faulty_quotes(spark, sf_dir), as_of=utc_literal(AS_OF))
    reasons = ops.quality_failures(summary.first().asDict(), MAX_LAG_MINUTES)
    return spark.createDataFrame(list(enumerate(reasons, 1)), "position int, reason string")


def dq_state_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks by day of two deliveries, the second with late rows for each day, and of all."""
    lake = _lake(spark, "check-states")
    history = _faulty_history(spark, sf_dir)
    for half in range(2):
        append_days(_silver(history.where(F.col("event_id") % 2 == half)), lake.history)
        start_checks(spark, lake, available_now=True).awaitTermination()
    states = read_check_states(spark, lake)
    counts = ["checked_rows", "null_symbol", "null_market_cap_usd", BAD_PRICE]
    days = states.select(F.date_format("dt", "yyyy-MM-dd").alias("day"), *counts, "newest_event_time")
    checked = states.agg(F.sum("checked_rows")).first()[0]
    whole = ops.states_summary(states, as_of=utc_literal(AS_OF)).withColumn("checked_rows", F.lit(checked))
    whole = whole.select(F.lit("all").alias("day"), *counts, "newest_event_time")
    return t.comparable(days.union(whole))


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of the raw records of each day against the day before."""
    records = t.drifting_records(spark, sf_dir)
    return ops.schema_drift(ops.record_fields(records, "value", "day"))


def record_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.record_fields(t.drifting_records(spark, sf_dir), "value", "day")


# Sinks


def sink_keyed_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "keyed") + "/records"
    events = t.raw_events(spark, sf_dir, faulty=True)
    ops.keyed_json(events).write.parquet(path)
    return spark.read.parquet(path)


def sink_history_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "append") + "/history"
    quotes = _silver(t.event_quotes(spark, sf_dir))
    append_days(quotes.where(F.col("dt") < F.lit(SPLIT_DAY)), path)
    append_days(quotes.where(F.col("dt") >= F.lit(SPLIT_DAY)), path)
    return _values(read_table(spark, path, SILVER_SCHEMA))


def sink_dynamic_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days with negated prices, then the later days replaced by the true ones."""
    path = scratch_path(spark, "overwrite") + "/latest"
    latest = ops.latest_per_day(_silver(t.event_quotes(spark, sf_dir)))
    replace_days(latest.withColumn("price_usd", -F.col("price_usd")), path)
    replace_days(latest.where(F.col("dt") >= F.lit(SPLIT_DAY)), path)
    return _values(read_table(spark, path, SILVER_SCHEMA))


def sink_gold_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "quotes") + "/quotes"
    quotes = gold_quotes(t.event_quotes(spark, sf_dir))
    for _run in range(2):
        replace_days(quotes, path)
    return t.comparable(read_table(spark, path, GOLD_QUOTES_SCHEMA))


def sink_gold_quotes_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "line-quotes") + "/quotes"
    replace_days(gold_quotes(_silver(t.line_quotes(spark, sf_dir))), path)
    return t.comparable(read_table(spark, path, GOLD_QUOTES_SCHEMA))


def sink_gold_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "daily") + "/daily"
    daily = ops.daily_metrics(gold_quotes(t.event_quotes(spark, sf_dir)), unique_times=True)
    for _run in range(2):
        replace_days(daily, path)
    return _rounded(read_table(spark, path, GOLD_DAILY_SCHEMA))


def sink_snapshot_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "snapshot") + "/snapshot"
    quotes = _silver(t.event_quotes(spark, sf_dir))
    replace_table(quotes.drop("dt"), path)
    replace_table(ops.current_snapshot(quotes).drop("dt"), path)
    columns = [c for c in SILVER_VALUES if c != "dt"]
    return t.comparable(read_table(spark, path).select(*columns))


# Streams


def stream_poll_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark, "polls")
    t.write_polls(spark, sf_dir, lake.pages)
    start_polls(
        stream_pages(spark, lake.pages), lake, lake.records, available_now=True
    ).awaitTermination()
    event = F.from_json("value", BRONZE_SCHEMA)
    records = spark.read.parquet(lake.records)
    return records.select("key", event.alias("event")).select("key", "event.*")


def _landed(spark: SparkSession, sf_dir: str, label: str, faulty: bool) -> LakeConfig:
    lake = _lake(spark, label)
    records = t.topic_records(spark, sf_dir, faulty=faulty)
    records.select("key", "value", "partition").write.parquet(lake.records)
    return lake


def stream_bronze_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _landed(spark, sf_dir, "landing", faulty=True)
    records = spark.readStream.schema("key string, value string, partition int").parquet(
        lake.records
    )
    start_landing(records, lake, available_now=True).awaitTermination()
    return read_events(spark, lake.bronze).select(*BRONZE_SCHEMA.fieldNames())


def _by_halves(spark: SparkSession, sf_dir: str, lake: LakeConfig):
    """Write the raw lines in two deliveries, the second with late rows for each day."""
    records = t.topic_records(spark, sf_dir, faulty=True)
    late = F.col("event_id") % 2 == 1
    for half in (~late, late):
        t.write_lines(records.where(half), lake.bronze)
        yield


def stream_silver_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark, "history")
    for _half in _by_halves(spark, sf_dir, lake):
        events = stream_events(spark, lake.bronze)
        start_history(events, lake, available_now=True).awaitTermination()
    return _values(read_table(spark, lake.history, SILVER_SCHEMA))


def stream_silver_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark, "latest")
    for _half in _by_halves(spark, sf_dir, lake):
        events = stream_events(spark, lake.bronze)
        start_history(events, lake, available_now=True).awaitTermination()
        start_latest(spark, lake, available_now=True).awaitTermination()
    return _values(read_table(spark, lake.latest, SILVER_SCHEMA))


def stream_gold_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark, "gold")
    for _half in _by_halves(spark, sf_dir, lake):
        events = stream_events(spark, lake.bronze)
        start_history(events, lake, available_now=True).awaitTermination()
        start_gold(spark, lake, available_now=True).awaitTermination()
    return _rounded(read_table(spark, lake.daily, GOLD_DAILY_SCHEMA))


def stream_gold_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily metrics of two deliveries, the second late for every day, by deltas."""
    lake = replace(_lake(spark, "gold-delta"), gold_write="delta", delta_buckets=2)
    for _half in _by_halves(spark, sf_dir, lake):
        events = stream_events(spark, lake.bronze)
        start_history(events, lake, available_now=True).awaitTermination()
        start_gold(spark, lake, available_now=True).awaitTermination()
    return _rounded(read_table(spark, lake.daily, GOLD_DAILY_SCHEMA))


def stream_snapshot_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last row per coin of two deliveries, from the state of a stream."""
    lake = _lake(spark, "snapshot-state")
    for _half in _by_halves(spark, sf_dir, lake):
        events = stream_events(spark, lake.bronze)
        start_history(events, lake, available_now=True).awaitTermination()
        start_snapshot(spark, lake, available_now=True).awaitTermination()
    columns = [c for c in SILVER_VALUES if c != "dt"]
    return t.comparable(read_table(spark, lake.snapshot).select(*columns))


def src_parquet_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quotes of a few parts, from days that are laid out for it."""
    path = scratch_path(spark, "lookup") + "/history"
    append_days_for_lookup(_silver(t.line_quotes(spark, sf_dir)), path)
    quotes = read_table(spark, path, SILVER_SCHEMA)
    return _values(quotes.where(F.col("coin_id").isin(*LISTED_PARTS)))


def dedup_quotes_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplication without a shuffle, from a table in buckets by coin."""
    path = scratch_path(spark, "bucketed")
    name = f"history_{uuid.uuid4().hex}"
    quotes = _silver(t.line_quotes(spark, sf_dir))
    return _values(ops.dedup_quotes(save_bucketed(quotes, name, f"{path}/history")))


def compact_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row once after two compactions, with a delivery between them; and how many
    files there are left for a day at most."""
    lake = _lake(spark, "compact")
    quotes = _silver(t.event_quotes(spark, sf_dir))
    for half in range(2):
        append_days(quotes.where(F.hour("last_updated_ts") % 2 == half).repartition(4), lake.history, cluster=False)
        plans.compact_history(spark, lake)
    rows = _values(plans.read_history(spark, lake))
    files = live_files(spark, lake).groupBy("dt").count().agg(F.max("count").alias("files_per_day"))
    return rows.withColumn("files_per_day", F.lit(files.first()[0]))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the log holds of landing, rejects, history and quarantine of faulty records."""
    lake = _landed(spark, sf_dir, "run-log", faulty=True)
    records = spark.readStream.schema("key string, value string, partition int").parquet(lake.records)
    with RunLog(spark, lake) as log:
        for name, start in (("landing", start_landing), ("rejects", start_rejects)):
            log.finish(log.watch(start(records, lake, available_now=True), name))
        events = stream_events(spark, lake.bronze)
        for name, start in (("history", start_history), ("quarantine", start_quarantine)):
            log.finish(log.watch(start(events, lake, available_now=True), name))
    return run_totals(read_run_log(spark, lake))


# Whole runs


def flow_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages to keyed events."""
    path = scratch_path(spark, "flow") + "/pages"
    t.write_pages(spark, sf_dir, path)
    events = ops.pages_to_events(
        read_pages(spark, path),
        poll_time=utc_literal(AS_OF),
        run_id=F.lit("run"),
        source="events",
        vs_currency="usd",
    )
    return ops.keyed_json(events)


def flow_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark, "silver")
    t.write_lines(t.topic_records(spark, sf_dir, faulty=True), lake.bronze)
    for _run in range(2):
        build_silver(spark, lake)
    return _values(read_table(spark, lake.latest, SILVER_SCHEMA))


def flow_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark, "flow-gold")
    quotes = _silver(t.event_quotes(spark, sf_dir))
    append_days(quotes, lake.history)
    build_latest(spark, lake)
    for _run in range(2):
        build_gold(spark, lake)
    return _rounded(read_table(spark, lake.daily, GOLD_DAILY_SCHEMA))


def flow_gold_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark, "flow-snapshot")
    quotes = _silver(t.event_quotes(spark, sf_dir))
    append_days(quotes, lake.history)
    build_latest(spark, lake)
    build_gold(spark, lake)
    columns = [c for c in SILVER_VALUES if c != "dt"]
    return t.comparable(read_table(spark, lake.snapshot).select(*columns))


def flow_gold_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of quotes that tie in all but their lineage."""
    lake = _lake(spark, "flow-lines")
    quotes = _silver(t.line_quotes(spark, sf_dir))
    append_days(quotes, lake.history)
    build_latest(spark, lake)
    build_gold(spark, lake)
    return _rounded(read_table(spark, lake.daily, GOLD_DAILY_SCHEMA))


def flow_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries, the second late for every day, each taken in by a run."""
    lake = _lake(spark, "incremental")
    for _half in _by_halves(spark, sf_dir, lake):
        build_lake(spark, lake, start="bronze")
    return _rounded(read_table(spark, lake.daily, GOLD_DAILY_SCHEMA))


def flow_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each record of a run went: none is lost."""
    lake = _landed(spark, sf_dir, "quarantine", faulty=True)
    build_lake(spark, lake, start="records")
    places = {
        "all": lake.records,
        "history": lake.history,
        "quarantined": lake.quarantine,
        "rejected": lake.rejects,
    }
    counts = [
        spark.read.parquet(path).agg(F.lit(place).alias("place"), F.count(F.lit(1)).alias("records"))
        for place, path in places.items()
    ]
    return counts[0].union(counts[1]).union(counts[2]).union(counts[3])


def flow_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic records to bronze, silver and gold; the daily metrics at the end."""
    lake = _landed(spark, sf_dir, "lake", faulty=True)
    build_lake(spark, lake, start="records")
    return _rounded(read_table(spark, lake.daily, GOLD_DAILY_SCHEMA))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        src_api_page_explode,
        src_json_lines,
        src_parquet_partitioned,
        src_parquet_long_amounts,
        src_topic_decode,
        norm_event,
        norm_record_key,
        filter_id_list,
        filter_id_table,
        topn_page,
        topn_page_global,
        topn_page_deep,
        topn_page_global_deep,
        topn_page_indexed,
        topn_page_indexed_keys,
        topn_page_ties,
        silver_clean,
        quarantine_bad_records,
        tag_bad_records,
        contract_enforce,
        silver_latest,
        silver_latest_lines,
        dedup_quotes,
        dedup_quotes_lines,
        gold_snapshot,
        gold_snapshot_lines,
        daily_metrics,
        daily_metrics_lines,
        daily_metrics_repeated,
        run_event_counts,
        dq_required_columns,
        dq_null_counts,
        dq_price_positive,
        dq_freshness,
        dq_gate_report,
        dq_state_merge,
        record_fields,
        schema_drift,
        sink_keyed_json,
        sink_history_append,
        sink_dynamic_overwrite,
        sink_gold_quotes,
        sink_gold_quotes_lines,
        sink_gold_daily,
        sink_snapshot_overwrite,
        stream_poll_events,
        stream_bronze_files,
        stream_silver_history,
        stream_silver_latest,
        stream_gold_daily,
        stream_gold_delta,
        stream_snapshot_state,
        src_parquet_lookup,
        dedup_quotes_bucketed,
        compact_history,
        run_log,
        flow_events,
        flow_silver,
        flow_gold,
        flow_gold_snapshot,
        flow_gold_lines,
        flow_incremental,
        flow_quarantine,
        flow_end_to_end,
    )
}
