"""Gold and latest rows are made where the days of a table lie."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quotelake.operators import daily_metrics, dedup_quotes, latest_per_day
from quotelake.plans import build_gold, build_latest, days, gold
from quotelake.plans import silver as silver_plan
from quotelake.schemas import GOLD_DAILY_SCHEMA, GOLD_QUOTES_SCHEMA, SILVER_SCHEMA
from quotelake.sinks import append_days
from quotelake.sources import read_table
from tests.conftest import at, plan_of, rows_of, silver

WORK = {"latest": latest_per_day, "quotes": dedup_quotes, "daily": daily_metrics}


@pytest.fixture
def history(spark, lake):
    """Three days, one of them large, one hot coin, repeats, a row without day and one without coin."""
    rows = [
        {"event_time_ts": at(f"2024-01-0{day}T0{hour}:00:00"), "coin_id": coin, "price_usd": day + hour / 8, "ingestion_run_id": run}
        for day, hours in ((1, 2), (2, 6), (3, 3))
        for hour in range(hours)
        for coin in ("a", "a", "b", "c")
        for run in ("r1", "r2")
    ]
    rows += [{"dt": None, "event_time_ts": None}, {"dt": None, "event_time_ts": None, "coin_id": None}]
    rows += [{"event_time_ts": at("2024-01-02T09:00:00"), "coin_id": None}]
    append_days(silver(spark, *rows).repartition(3), lake.history)
    return read_table(spark, lake.history, SILVER_SCHEMA)


@pytest.mark.parametrize("task_rows, most_reads", [(1000, 8), (20, 8), (5, 100), (20, 1), (5, 1)])
@pytest.mark.parametrize("name", WORK)
def test_days_where_they_lie_give_the_same_rows(history, monkeypatch, name, task_rows, most_reads):
    monkeypatch.setattr(days, "TASK_ROWS", task_rows)
    monkeypatch.setattr(days, "LEAST_ROWS", 1)
    monkeypatch.setattr(days, "MOST_READS", most_reads)
    monkeypatch.setattr(days, "MOST_TASKS", 2)
    work = WORK[name]
    jobs = list(days.day_jobs(history, work))
    found = [row for job in jobs for row in rows_of(job)]
    assert sorted(found, key=repr) == rows_of(work(history))
    # A job that replaces days leaves alone those of other jobs.
    touched = [row["dt"] for job in jobs for row in job.select("dt").distinct().collect()]
    assert len(touched) == len(set(touched)) == 4


def test_only_a_very_large_day_is_shuffled(history, monkeypatch):
    monkeypatch.setattr(days, "TASK_ROWS", 20)
    monkeypatch.setattr(days, "MOST_READS", 1)
    large, near = days.day_jobs(history, dedup_quotes)
    assert "Exchange" in plan_of(large) and "Partial" in plan_of(dedup_quotes(history))
    assert {str(row["dt"]) for row in large.select("dt").distinct().collect()} == {"2024-01-02", "2024-01-03"}
    assert "Exchange" not in plan_of(near)


def test_each_task_is_a_partition(history, monkeypatch):
    monkeypatch.setattr(days, "TASK_ROWS", 20)
    monkeypatch.setattr(days, "LEAST_ROWS", 20)
    (job,) = days.day_jobs(history, dedup_quotes)
    # One each for the first day and the rows without a day, three and two for the others.
    assert job.rdd.getNumPartitions() == 7


def test_a_table_without_rows_is_one_job(spark, lake):
    append_days(silver(spark, {}).where(F.lit(False)), lake.history)
    empty = read_table(spark, lake.history, SILVER_SCHEMA)
    assert [job.count() for job in days.day_jobs(empty, dedup_quotes)] == [0]


def test_latest_rows_quotes_and_daily_metrics_are_written_without_a_shuffle(spark, lake, monkeypatch):
    """Each was shuffled twice: to be grouped, and to gather its days."""
    rows = [{"event_time_ts": at(f"2024-01-0{n}T00:00:00"), "coin_id": c} for n in (1, 2) for c in "ab"]
    append_days(silver(spark, *rows, *rows), lake.history)
    plans = {}

    def watched(write):
        def watch(table, path, **options):
            assert options["cluster"] is False
            plans[path] = plan_of(table)
            write(table, path, **options)

        return watch

    with monkeypatch.context() as patch:
        patch.setattr(silver_plan, "replace_days", watched(silver_plan.replace_days))
        build_latest(spark, lake)
        patch.setattr(gold, "build_snapshot", lambda *_: None)
        patch.setattr(gold, "replace_days", watched(gold.replace_days))
        patch.setattr(gold, "replace_table", watched(gold.replace_table))
        build_gold(spark, lake)
    assert set(plans) == {lake.latest, lake.staging, lake.quotes, lake.daily}
    assert not [path for path, plan in plans.items() if "Exchange" in plan]
    history = read_table(spark, lake.history, SILVER_SCHEMA)
    quotes = dedup_quotes(history).select(*GOLD_QUOTES_SCHEMA.fieldNames())
    assert rows_of(read_table(spark, lake.latest, SILVER_SCHEMA)) == rows_of(latest_per_day(history))
    assert rows_of(read_table(spark, lake.quotes, GOLD_QUOTES_SCHEMA)) == rows_of(quotes)
    assert rows_of(read_table(spark, lake.daily, GOLD_DAILY_SCHEMA)) == rows_of(daily_metrics(quotes))
