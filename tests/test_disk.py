"""What a gold run keeps on disk: tables, and no shuffle longer than a write needs it."""

from __future__ import annotations

import time
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quotelake import session
from quotelake.operators import current_snapshot, enforce_contract
from quotelake.plans import build_gold, build_latest, build_snapshot, days, gold
from quotelake.session import dropped_shuffles, short_splits
from quotelake.sinks import append_days, replace_days, replace_table
from quotelake.sources import read_table
from tests.conftest import at, plan_of, rows_of, silver

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = {files.apply(i).getName() for i in range(files.size())}
    return {name for name in names if name.startswith("shuffle_") and name.endswith(".data")}


@pytest.mark.parametrize("write", [append_days, replace_days, replace_table])
def test_shuffles_of_a_write_go_with_it(spark, tmp_path, write):
    """They stayed next to all later tables, until the driver collected its garbage."""
    rows = silver(spark, {}, {"coin_id": "b"}).repartition(3, "coin_id")
    kept = rows.cache()  # A cached table lives on without its shuffle.
    try:
        assert kept.count() == 2
        before = shuffle_files(spark)
        write(kept.repartition(3, "name"), str(tmp_path / "t"))
        end = time.time() + 20
        while (left := shuffle_files(spark) - before) and time.time() < end:
            time.sleep(0.1)
        assert not left
        assert rows_of(read_table(spark, str(tmp_path / "t"), rows.schema)) == rows_of(kept)
    finally:
        kept.unpersist()


SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.mark.parametrize("before, inside", [("128MB", "16777216b"), ("1g", "16777216b"), ("8m", "8m"), ("4096", "4096")])
def test_tasks_of_a_write_read_little_at_once(spark, before, inside):
    was = spark.conf.get(SPLIT)
    try:
        spark.conf.set(SPLIT, before)
        with short_splits(spark):
            assert spark.conf.get(SPLIT) == inside
        assert spark.conf.get(SPLIT) == before
    finally:
        spark.conf.set(SPLIT, was)


@pytest.mark.parametrize("cluster", [True, False])
def test_tables_are_written_from_short_splits(spark, tmp_path, monkeypatch, cluster):
    """One task read all of this file, and many million rows of a larger one."""
    text = F.sha2(F.col("id").cast("string"), 256).alias("x")
    spark.range(600_000).select(text).coalesce(1).write.option("parquet.block.size", "2000000").parquet(source := str(tmp_path / "s"))
    monkeypatch.setattr(session, "SPLIT_BYTES", 4_000_000)
    task, day = F.spark_partition_id().alias("task"), F.lit("2024-01-01").cast("date").alias("dt")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        append_days(spark.read.parquet(source).select("x", task, day), path := str(tmp_path / "t"), cluster=cluster)
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
    found = spark.read.parquet(path)
    assert found.count() == 600_000 and found.select("task").distinct().count() > 5


def test_the_setting_is_put_back(spark):
    before = spark.conf.get(CLEANUP, None)
    with pytest.raises(KeyError), dropped_shuffles(spark):
        assert spark.conf.get(CLEANUP) == "true"
        raise KeyError
    assert spark.conf.get(CLEANUP, None) == before


def test_all_tables_of_a_gold_run_are_packed_alike(spark, lake):
    append_days(silver(spark, {}, {"coin_id": "b"}), lake.history)
    build_latest(spark, lake)
    build_gold(spark, lake)
    for path in (lake.history, lake.latest, lake.staging, lake.quotes, lake.daily, lake.snapshot):
        files = list(Path(path).rglob("*.parquet"))
        assert files and {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}


def odd_latest(spark):
    """Coins of many days; ties in time over days and within one, null days, coins and times."""
    rows = [
        {"event_time_ts": at(f"2024-01-{day:02}T0{n}:00:00"), "coin_id": coin, "price_usd": day + n / 8}
        for day in range(1, 9)
        for n, coin in enumerate("abcd")
    ]
    late = at("2024-03-01T00:00:00")
    for n, day in enumerate((2, 3)):
        more = {"coin_id": "a", "event_time_ts": late, "dt": at(f"2024-01-0{day}T00:00:00").date()}
        rows += [{**more, "ingestion_run_id": f"r{1 - n}"}, {**more, "price_usd": 7.0}]
        rows += [{**more, "coin_id": "b", "last_updated_ts": None if n else late}]
    rows += [{"coin_id": "e", "event_time_ts": None, "dt": at("2024-01-05T00:00:00").date(), "price_usd": p} for p in (1.0, 2.0)]
    rows += [{"coin_id": None}, {"coin_id": None, "event_time_ts": late, "dt": None}]
    rows += [{"coin_id": "d", "event_time_ts": late, "dt": None}, {"coin_id": "f", "event_time_ts": None}]
    return silver(spark, *rows)


@pytest.mark.parametrize("task_rows, most_reads", [(1000, 8), (2, 8), (2, 1)])
def test_snapshot_of_many_rows_shuffles_only_the_last_of_each_coin(spark, lake, monkeypatch, task_rows, most_reads):
    append_days(odd_latest(spark).repartition(3), lake.latest)
    latest = enforce_contract(read_table(spark, lake.latest))
    expected = rows_of(current_snapshot(latest).drop("dt"))
    monkeypatch.setattr(gold, "SHUFFLED_ROWS", 0)
    monkeypatch.setattr(days, "TASK_ROWS", task_rows)
    monkeypatch.setattr(days, "LEAST_ROWS", 1)
    monkeypatch.setattr(days, "MOST_READS", most_reads)
    monkeypatch.setattr(days, "MOST_TASKS", 3)
    plans, found = [], []

    def watched(write):
        def watch(table, path, **options):
            plans.append((path, plan_of(table)))
            write(table, path, **options)

        return watch

    def ranked(rows):
        found.append(rows.count())
        return current_snapshot(rows)

    monkeypatch.setattr(gold, "replace_table", watched(gold.replace_table))
    monkeypatch.setattr(gold, "append_days", watched(gold.append_days))
    monkeypatch.setattr(gold, "current_snapshot", ranked)
    largest = "spark.sql.maxSinglePartitionBytes"
    before = spark.conf.get(largest)
    try:
        # Spark takes each day for as large as its table, which is over this.
        spark.conf.set(largest, "1b")
        for _run in range(2):
            build_snapshot(spark, lake)
        assert spark.conf.get(largest) == "1b"
    finally:
        spark.conf.set(largest, before)
    assert rows_of(spark.read.parquet(lake.snapshot)) == expected
    # Seven coins, null among them; four rows more tie in time with the last of theirs.
    assert len(expected) == 7 and found == [11, 11] and latest.count() > 40
    (times, *picked) = [plan for path, plan in plans if path != lake.snapshot][: len(plans) // 2 - 1]
    assert "WindowGroupLimit" in times and "price_usd" not in times and "ingestion_run_id" not in times
    assert picked and (most_reads == 1 or not [plan for plan in picked if "Exchange" in plan])


def test_snapshot_of_coins_that_hardly_repeat_is_ranked_at_once(spark, lake, monkeypatch):
    rows = [{"coin_id": coin} for coin in "abc"] + [{"event_time_ts": at("2024-01-02T00:00:00")}]
    append_days(silver(spark, *rows), lake.latest)
    monkeypatch.setattr(gold, "SHUFFLED_ROWS", 0)
    monkeypatch.setattr(gold, "day_jobs", lambda *_: pytest.fail("no second look is worth it"))
    build_snapshot(spark, lake)
    latest = enforce_contract(read_table(spark, lake.latest))
    assert rows_of(spark.read.parquet(lake.snapshot)) == rows_of(current_snapshot(latest).drop("dt"))


def test_rows_without_lineage_get_none(spark, lake, monkeypatch):
    rows = silver(spark, *[{"event_time_ts": at(f"2024-01-0{n}T00:00:00"), "price_usd": n / 2} for n in range(1, 9)])
    append_days(rows.drop("ingestion_run_id", "source_file"), lake.latest)
    monkeypatch.setattr(gold, "SHUFFLED_ROWS", 0)
    build_snapshot(spark, lake)
    found = spark.read.parquet(lake.snapshot)
    assert "source_file" not in found.columns and [r.price_usd for r in found.collect()] == [4.0]
