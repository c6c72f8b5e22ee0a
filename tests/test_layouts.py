"""Snapshot state, lookups, buckets and packed files: the same rows, for less reading."""

from __future__ import annotations

import random
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quotelake.operators import current_snapshot, dedup_quotes, latest_per_day
from quotelake.plans import build_gold, compact, compact_history, read_history, update_gold
from quotelake.schemas import GOLD_DAILY_SCHEMA, SILVER_SCHEMA
from quotelake.sinks import append_days, append_days_for_lookup, replace_days, save_bucketed, tables
from quotelake.sources import read_table, stream_events
from quotelake.streaming import snapshot, start_history, start_snapshot
from tests.conftest import at, event, plan_of, rows_of, silver, write_lines


def some_quotes(spark, seed: int, many: int):
    pick = random.Random(seed)
    rows = []
    for number in range(many):
        time = at("2024-01-01T00:00:00") + timedelta(days=pick.randrange(3), minutes=pick.randrange(5))
        updated = None if pick.random() < 0.3 else time + timedelta(seconds=pick.randrange(3))
        run = f"r{seed}-{pick.randrange(4)}"
        rows.append(
            {"event_time_ts": time, "last_updated_ts": updated, "coin_id": pick.choice("abc"), "ingestion_run_id": run, "price_usd": float(number + 1)}
        )
    return silver(spark, *rows)


# Snapshot


def run_snapshot(spark, lake) -> list[tuple]:
    start_snapshot(spark, lake, available_now=True).awaitTermination()
    return rows_of(read_table(spark, lake.snapshot, SILVER_SCHEMA))


def test_snapshot_state_equals_the_ranking_after_each_delivery(spark, lake):
    for seed in range(3):
        append_days(some_quotes(spark, seed, 12), lake.history)
        assert run_snapshot(spark, lake) == rows_of(current_snapshot(read_table(spark, lake.history, SILVER_SCHEMA)))
    # The state is on disk, in the checkpoint, and no setting is left behind.
    assert list(Path(lake.checkpoint("snapshot")).rglob("*.zip")) or list(Path(lake.checkpoint("snapshot")).rglob("*.changelog"))
    assert spark.conf.get(snapshot.PROVIDER, None) != snapshot.ROCKSDB


def test_snapshot_reads_neither_history_nor_latest_rows_again(spark, lake):
    append_days(silver(spark, {"coin_id": "a"}, {"coin_id": "b"}), lake.history)
    run_snapshot(spark, lake)
    for file in Path(lake.history).rglob("part-*"):
        raw = file.read_bytes()
        end = len(raw) - 8 - int.from_bytes(raw[-8:-4], "little")
        file.write_bytes(b"PAR1" + bytes(end - 4) + raw[end:])
    older = {"coin_id": "b", "event_time_ts": at("2023-01-01T00:00:00"), "price_usd": 7.0}
    append_days(silver(spark, {"coin_id": "a", "event_time_ts": at("2024-01-02T00:00:00")}, older, {"coin_id": "c"}), lake.history)
    run_snapshot(spark, lake)
    got = {r.coin_id: (r.event_time_ts.day, r.price_usd) for r in read_table(spark, lake.snapshot, SILVER_SCHEMA).collect()}
    assert got == {"a": (2, 1.0), "b": (1, 1.0), "c": (1, 1.0)}


@pytest.mark.parametrize("failing_write", [1, 2, 3])
def test_snapshot_survives_a_failure_while_it_is_replaced(spark, lake, monkeypatch, failing_write):
    append_days(some_quotes(spark, 1, 9), lake.history)
    run_snapshot(spark, lake)
    append_days(some_quotes(spark, 2, 9), lake.history)
    write, done = snapshot.replace_table, []

    def failing(table, path, **options):
        done.append(path)
        if len(done) == failing_write:
            table.limit(0).write.mode("overwrite").parquet(path)
            raise RuntimeError("lost")
        write(table, path, **options)

    monkeypatch.setattr(snapshot, "replace_table", failing)
    with pytest.raises(Exception, match="lost"):
        run_snapshot(spark, lake)
    monkeypatch.undo()
    assert run_snapshot(spark, lake) == rows_of(current_snapshot(read_table(spark, lake.history, SILVER_SCHEMA)))


# Lookup


def rows_read(df) -> int:
    """Rows that the scans of a query gave."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(at).metrics().apply("numOutputRows").value() for at in range(leaves.size()))


def test_lookup_skips_row_groups(spark, tmp_path):
    rows = silver(spark, {}).crossJoin(spark.range(4000)).withColumn("coin_id", F.format_string("c%05d", F.col("id") % 1000)).drop("id")
    append_days_for_lookup(rows, path := str(tmp_path / "lookup"), group_bytes=4000)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        few = spark.read.parquet(path).where(F.col("coin_id").isin("c00123", "c00900"))
        assert few.count() == 8 and 8 <= rows_read(few) < 1000
        # Between the bounds of a row group, and not in it: the Bloom filter tells.
        assert rows_read(spark.read.parquet(path).where("coin_id = 'c00123x'")) == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


# Buckets


@pytest.mark.parametrize("operator", [dedup_quotes, latest_per_day, current_snapshot])
def test_rankings_of_bucketed_quotes_do_not_shuffle(spark, tmp_path, operator):
    quotes = some_quotes(spark, 5, 60)
    name = f"bucketed_{operator.__name__}"
    try:
        table = save_bucketed(quotes, name, str(tmp_path / name), buckets=3)
        assert "Exchange" not in plan_of(operator(table))
        assert rows_of(operator(table)) == rows_of(operator(quotes))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_buckets_grow_in_number_with_the_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "BUCKET_ROWS", 20)
    for coins, buckets in ((0, 8), (40, 8), (600, 60)):
        quotes = silver(spark, {}).crossJoin(spark.range(2 * coins)).withColumn("coin_id", F.format_string("c%05d", F.col("id") % max(1, coins))).drop("id")
        name = f"bucketed_{coins}"
        try:
            table = save_bucketed(quotes, name, str(tmp_path / name))
            described = {row.col_name: row.data_type for row in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
            assert int(described["Num Buckets"]) == buckets
            deduplicated = dedup_quotes(table)
            assert "Exchange" not in plan_of(deduplicated)
            assert rows_of(deduplicated) == rows_of(dedup_quotes(quotes))
            sizes = [row["count"] for row in deduplicated.groupBy(F.spark_partition_id()).count().collect()]
            assert max(sizes, default=0) < 40 or buckets == 8
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


# Compaction


def sizes(spark, lake) -> dict[object, list[int]]:
    found: dict[object, list[int]] = {}
    for row in compact.live_files(spark, lake).collect():
        found.setdefault(row.dt, []).append(row.length)
    return found


def test_packed_days_hold_every_row_once_in_few_files(spark, lake):
    target = 30_000
    for seed in range(3):
        append_days(some_quotes(spark, seed, 40).repartition(6), lake.history, cluster=False)
        before = sizes(spark, lake)
        compact_history(spark, lake, target_bytes=target)
        assert rows_of(read_history(spark, lake)) == rows_of(read_table(spark, lake.history, SILVER_SCHEMA))
        for day, lengths in sizes(spark, lake).items():
            assert len(lengths) < len(before[day])
            assert len(lengths) <= 1 + 2 * sum(before[day]) / target and max(lengths) <= 1.5 * target
    day = at("2024-01-02T00:00:00").date()
    assert {row.dt for row in read_history(spark, lake, [(day, day)]).collect()} == {day}
    assert compact_history(spark, lake.__class__(root=lake.root + "/nothing")) == 0


def test_a_compaction_that_is_cut_loses_nothing(spark, lake, monkeypatch):
    append_days(some_quotes(spark, 1, 40).repartition(6), lake.history, cluster=False)
    whole = rows_of(read_table(spark, lake.history, SILVER_SCHEMA))

    def lost(config):
        raise RuntimeError("lost")

    list_of = compact._list_of
    calls = []
    monkeypatch.setattr(compact, "_list_of", lambda config: list_of(config) if not calls.append(1) and len(calls) == 1 else lost(config))
    with pytest.raises(RuntimeError, match="lost"):
        compact_history(spark, lake)
    monkeypatch.undo()
    # Its files are there, and no reader takes them.
    assert list(Path(lake.compacted).rglob("part-*"))
    assert rows_of(read_history(spark, lake)) == whole
    assert compact_history(spark, lake) > 0
    assert rows_of(read_history(spark, lake)) == whole


def test_streams_and_gold_see_packed_rows_once(spark, lake):
    for delivery in range(2):
        for number in range(5):
            line = event(event_time=f"2024-01-0{1 + delivery}T0{number}:00:00+00:00", price_usd=number + 1.0)
            write_lines(lake.bronze, f"{delivery}-{number}.json", line)
            start_history(stream_events(spark, lake.bronze), lake, available_now=True).awaitTermination()
        compact_history(spark, lake)
        replace_days(latest_per_day(read_history(spark, lake)), lake.latest)
        update_gold(spark, lake)
    by_stream = rows_of(read_table(spark, lake.daily, GOLD_DAILY_SCHEMA))
    build_gold(spark, lake)
    assert rows_of(read_table(spark, lake.daily, GOLD_DAILY_SCHEMA)) == by_stream and len(by_stream) == 2
    assert read_history(spark, lake).count() == 10 and max(map(len, sizes(spark, lake).values())) == 1
