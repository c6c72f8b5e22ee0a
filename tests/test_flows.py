"""Sinks, streams and whole runs: repeatable, and streaming equals batch."""

from __future__ import annotations

import json
import os
import shutil
from dataclasses import replace
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from quotelake import LakeConfig, QualityError
from quotelake.__main__ import main as command_line
from quotelake.functions import utc_literal
from quotelake.operators import (
    clean_events,
    cut_ranges,
    daily_metrics,
    day_ranges,
    dedup_quotes,
    in_days,
    last_day,
    latest_per_day,
    touched_days,
)
from quotelake.plans import build_gold, build_lake, build_silver, gold, update_gold
from quotelake.plans.gold import gold_quotes
from quotelake.schemas import GOLD_DAILY_SCHEMA, GOLD_QUOTES_SCHEMA, SILVER_SCHEMA
from quotelake.sinks import append_days, replace_days, replace_table
from quotelake.sources import read_events, read_pages, read_table, stream_events, stream_pages
from quotelake.streaming import (
    poll_events,
    start_gold,
    start_history,
    start_lake,
    start_landing,
    start_latest,
    start_polls,
    start_quarantine,
    start_rejects,
    start_serving,
)
from tests.conftest import at, event, plan_of, rows_of, silver, write_lines

NOW = ("ingestion_time", "source_file")


def deliveries(count: int = 6) -> list[list[dict | str]]:
    """Files of raw lines: three days, two coins, late rows, repeats and faults."""
    files = []
    for n in range(count):
        lines = [
            event(
                coin_id=coin,
                event_time=f"2024-01-0{day}T{(n * 5 + hour) % 24:02d}:00:00+00:00",
                last_updated=f"2024-01-0{day}T00:00:0{n}Z",
                price_usd=1.0 + day * 10 + n + hour / 10,
            )
            for day in (1, 2, 3)
            for hour in (0, 5)
            for coin in ("a", "b")
        ]
        files.append([*lines, lines[0], "broken {", event(coin_id=None)])
    return files


def batch_results(spark, lake):
    """What one run over all of bronze has to give."""
    silver_rows = clean_events(read_events(spark, lake.bronze))
    quotes = dedup_quotes(silver_rows.select(*GOLD_QUOTES_SCHEMA.fieldNames()))
    return {
        "history": rows_of(silver_rows, *NOW),
        "latest": rows_of(latest_per_day(silver_rows), *NOW),
        "quotes": rows_of(quotes),
        "daily": rows_of(daily_metrics(quotes)),
    }


def tables(spark, lake):
    return {
        "history": rows_of(read_table(spark, lake.history, SILVER_SCHEMA), *NOW),
        "latest": rows_of(read_table(spark, lake.latest, SILVER_SCHEMA), *NOW),
        "quotes": rows_of(read_table(spark, lake.quotes, GOLD_QUOTES_SCHEMA)),
        "daily": rows_of(read_table(spark, lake.daily, GOLD_DAILY_SCHEMA)),
    }


def stream_all(spark, lake, **options):
    events = stream_events(spark, lake.bronze, **options)
    start_history(events, lake, available_now=True).awaitTermination()
    start_latest(spark, lake, available_now=True, files_per_batch=4).awaitTermination()
    start_gold(spark, lake, available_now=True).awaitTermination()


def uncommit(lake, stream):
    """Undo the last commit of a stream, as if its driver had been lost before it."""
    commits = Path(lake.checkpoint(stream)) / "commits"
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        (commits / name).unlink(missing_ok=True)


@pytest.mark.parametrize("files_per_batch", [None, 2, 1])
def test_streaming_equals_batch_for_any_split(spark, lake, files_per_batch):
    for n, lines in enumerate(deliveries()):
        write_lines(lake.bronze, f"{n}.json", *lines, partition=n % 2)
    stream_all(spark, lake, files_per_batch=files_per_batch)
    assert tables(spark, lake) == batch_results(spark, lake)


def test_streaming_goes_on_after_a_restart(spark, lake):
    files = deliveries()
    for n, lines in enumerate(files[:3]):
        write_lines(lake.bronze, f"{n}.json", *lines)
    stream_all(spark, lake)
    for n, lines in enumerate(files[3:], 3):
        write_lines(lake.bronze, f"{n}.json", *lines)
    stream_all(spark, lake)
    stream_all(spark, lake)
    assert tables(spark, lake) == batch_results(spark, lake)


@pytest.mark.parametrize("stream", ["history", "latest", "gold"])
def test_a_batch_that_was_not_committed_is_replayed(spark, lake, stream):
    for n, lines in enumerate(deliveries()):
        write_lines(lake.bronze, f"{n}.json", *lines)
    stream_all(spark, lake)
    uncommit(lake, stream)
    stream_all(spark, lake)
    assert tables(spark, lake) == batch_results(spark, lake)


def test_silver_and_gold_runs_are_repeatable(spark, lake):
    for n, lines in enumerate(deliveries()):
        write_lines(lake.bronze, f"{n}.json", *lines)
    for _run in range(2):
        build_silver(spark, lake, quarantine=True, files_per_batch=2)
        build_gold(spark, lake)
        assert tables(spark, lake) == batch_results(spark, lake)
    snapshot = read_table(spark, lake.snapshot)
    assert "dt" not in snapshot.columns and snapshot.count() == 2
    dropped = spark.read.parquet(lake.quarantine).groupBy("reason").count().collect()
    assert {r["reason"]: r["count"] for r in dropped} == {"unreadable": 6, "no_coin_id": 6}


def test_append_mode_adds_the_rows_again(spark, lake):
    lake = replace(lake, gold_write="append")
    append_days(silver(spark, {}, {"coin_id": "b"}), lake.history)
    append_days(silver(spark, {}), lake.latest)
    for run in (1, 2):
        build_gold(spark, lake)
        assert read_table(spark, lake.quotes, GOLD_QUOTES_SCHEMA).count() == 2 * run
        assert read_table(spark, lake.daily, GOLD_DAILY_SCHEMA).count() == 2 * run


@pytest.mark.parametrize("days_per_job", [1, 2, 100])
def test_days_in_several_jobs_give_the_same_tables(spark, lake, days_per_job):
    for n, lines in enumerate(deliveries()):
        write_lines(lake.bronze, f"{n}.json", *lines)
    build_silver(spark, lake)
    build_gold(spark, replace(lake, days_per_job=days_per_job))
    assert tables(spark, lake) == batch_results(spark, lake)


def test_rows_without_a_day_reach_the_checks_in_any_case(spark, lake):
    rows = silver(spark, {}, {"event_time_ts": None, "dt": None})
    append_days(rows, lake.history)
    append_days(silver(spark, {}), lake.latest)
    for days_per_job in (None, 1):
        with pytest.raises(QualityError) as error:
            build_gold(spark, replace(lake, days_per_job=days_per_job))
        assert error.value.reasons[:2] == ["null_dt", "null_event_time_ts"]


def test_nothing_is_published_when_a_check_fails(spark, lake):
    append_days(silver(spark, {}), lake.history)
    append_days(silver(spark, {}), lake.latest)
    build_gold(spark, lake)
    before = tables(spark, lake)
    bad = silver(spark, {"coin_id": "b", "price_usd": 0.0, "name": None})
    append_days(bad, lake.history)
    with pytest.raises(QualityError) as error:
        build_gold(spark, lake)
    assert error.value.reasons == ["null_name", "price_usd_null_or_non_positive"]
    after = tables(spark, lake)
    assert (after["quotes"], after["daily"]) == (before["quotes"], before["daily"])


def test_a_bad_row_that_loses_deduplication_is_not_seen(spark, lake):
    rows = silver(
        spark,
        {"price_usd": -5.0, "last_updated_ts": at("2024-01-01T00:00:01")},
        {"price_usd": 5.0, "last_updated_ts": at("2024-01-01T00:00:02")},
    )
    append_days(rows, lake.history)
    append_days(rows.where("price_usd > 0"), lake.latest)
    build_gold(spark, lake)
    assert read_table(spark, lake.quotes, GOLD_QUOTES_SCHEMA).count() == 1


def test_stale_history_fails(spark, lake):
    append_days(silver(spark, {}), lake.history)
    with pytest.raises(QualityError, match="freshness_lag_minutes=120.0"):
        build_gold(
            spark,
            replace(lake, max_lag_minutes=60),
            as_of=utc_literal(at("2024-01-01T02:00:00")),
        )


def test_late_rows_for_an_old_day_are_as_fresh_as_the_history(spark, lake):
    """Freshness belongs to the whole history, not to the touched days."""
    lake = replace(lake, max_lag_minutes=60)
    rows = silver(spark, {}, {"event_time_ts": at("2024-01-09T00:00:00")})
    append_days(rows, lake.history)
    append_days(rows, lake.latest)
    old = [at("2024-01-01").date()]
    build_gold(spark, lake, days=old, as_of=utc_literal(at("2024-01-09T00:30:00")))
    assert [r.dt for r in read_table(spark, lake.quotes, GOLD_QUOTES_SCHEMA).collect()] == old
    with pytest.raises(QualityError, match="freshness_lag_minutes=90.0"):
        build_gold(spark, lake, days=old, as_of=utc_literal(at("2024-01-09T01:30:00")))


def test_missing_columns_are_reported_before_anything_is_read(spark, lake):
    append_days(silver(spark, {}).drop("symbol"), lake.history)
    with pytest.raises(QualityError, match="missing_columns"):
        build_gold(spark, lake)


def test_gold_stream_stops_at_a_failed_check_and_tries_again(spark, lake):
    write_lines(lake.bronze, "0.json", event(price_usd=-1))
    start_history(stream_events(spark, lake.bronze), lake, available_now=True).awaitTermination()
    for _attempt in range(2):
        query = start_gold(spark, lake, available_now=True)
        with pytest.raises(StreamingQueryException, match="price_usd_null_or_non_positive"):
            query.awaitTermination()
    assert not Path(lake.quotes).exists()


def day(text):
    return date.fromisoformat(text)


def test_days_become_ranges(spark):
    days = ["2023-12-30", "2023-12-31", "2024-01-01", "2024-01-03", "2024-01-03", "2024-02-01"]
    rows = silver(spark, *[{"event_time_ts": at(f"{d}T00:00:00")} for d in days], {"dt": None})
    want = [
        (day("2023-12-30"), day("2024-01-01")),
        (day("2024-01-03"), day("2024-01-03")),
        (day("2024-02-01"), day("2024-02-01")),
    ]
    assert touched_days(rows) == want == day_ranges(map(day, days))
    assert last_day(want) == day("2024-02-01") and last_day([]) is None
    assert in_days(rows, want).count() == 6
    assert in_days(rows, None).count() == 7 and in_days(rows, []).count() == 0
    assert touched_days(rows.limit(0)) == []


def test_ranges_are_cut_into_jobs_of_a_number_of_days():
    ranges = [(day("2024-01-01"), day("2024-01-05")), (day("2024-02-01"), day("2024-02-01"))]
    cut = list(cut_ranges(ranges, 2))
    assert [sum((b - a).days + 1 for a, b in group) for group in cut] == [2, 2, 2]
    assert cut[2] == [(day("2024-01-05"), day("2024-01-05")), ranges[1]]


@pytest.mark.parametrize("step", [1, 2])
def test_thousands_of_touched_days_prune_and_keep_to_their_jobs(spark, lake, monkeypatch, step):
    start, count = day("2000-01-01"), 5000
    days = spark.range(0, count * step, step).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("dt"))
    ranges = touched_days(days)
    assert len(ranges) == (1 if step == 1 else count)
    append_days(silver(spark, *[{"event_time_ts": at(f"{y}-01-01T00:00:00")} for y in (1990, 2000)]), lake.history)
    history = read_table(spark, lake.history, SILVER_SCHEMA)
    plan = plan_of(in_days(history, ranges))
    assert "2000-01-01" in plan.split("PartitionFilters: [")[1].split("]")[0]
    jobs = []
    monkeypatch.setattr(gold, "gold_quotes", lambda part: jobs.append(part) or gold_quotes(part))
    staged, metrics = gold.stage_quotes(spark, replace(lake, days_per_job=1000), ranges)
    assert len(jobs) == 5
    assert staged.count() == 1 and metrics["newest_event_time"] == datetime(2000, 1, 1)


def test_no_days_are_nothing_to_do(spark, lake):
    append_days(silver(spark, {}), lake.history)
    build_gold(spark, lake, days=[])
    assert not Path(lake.quotes).exists()


def test_a_run_with_nothing_new_writes_no_file(spark, lake):
    write_lines(lake.bronze, "0.json", *deliveries(1)[0])
    build_lake(spark, lake, start="bronze")
    served = [lake.quotes, lake.daily, lake.snapshot, lake.latest, lake.history, lake.quarantine]
    before = {f: f.stat().st_mtime_ns for path in served for f in Path(path).rglob("*.parquet")}
    build_lake(spark, lake, start="bronze")
    after = {f: f.stat().st_mtime_ns for path in served for f in Path(path).rglob("*.parquet")}
    assert before == after and before


def test_incremental_runs_equal_a_full_one(spark, lake, tmp_path):
    whole = LakeConfig(root=str(tmp_path / "whole"), max_lag_minutes=10**9)
    for n, lines in enumerate(deliveries(3)):
        for config in (lake, whole):
            write_lines(config.bronze, f"{n}.json", *lines)
        build_lake(spark, lake, start="bronze")
    build_lake(spark, whole, start="bronze", full=True)
    assert tables(spark, lake) == tables(spark, whole)


def test_update_gold_raises_the_failed_check(spark, lake):
    append_days(silver(spark, {"price_usd": -1.0}), lake.history)
    with pytest.raises(QualityError, match="price_usd_null_or_non_positive") as failure:
        update_gold(spark, lake)
    assert failure.value.reasons == ["price_usd_null_or_non_positive"]
    assert not Path(lake.quotes).exists()


def test_no_record_is_lost(spark, lake):
    bad = '{"event_time": "2024-01-01T00:00:00Z", "coin_id": null, "extra": "kept"}'
    write_records(lake, "0.json", json.dumps(event()), "no json", bad, '[{"coin_id": "x"}]', None)
    records = spark.createDataFrame(spark.read.json(lake.records).select("key", "value").collect())
    shutil.rmtree(lake.records)
    records.write.parquet(lake.records)
    build_lake(spark, lake, start="records")
    kept = {r.record: r.reason for r in spark.read.parquet(lake.quarantine).collect()}
    assert kept == {bad: "no_coin_id", '[{"coin_id": "x"}]': "no_event_time"}
    assert sorted(map(str, (r.value for r in spark.read.parquet(lake.rejects).collect()))) == ["None", "no json"]
    assert read_table(spark, lake.quotes).count() == 1
    off = replace(lake, root=lake.root + "/off")
    records.write.parquet(off.records)
    build_lake(spark, off, start="records", quarantine=False)
    assert not Path(off.quarantine).exists() and not Path(off.rejects).exists()


def test_amounts_as_longs_are_read_and_written_on(spark, lake):
    lake = replace(lake, integral_amounts=True)
    for n, coin in enumerate("bc"):
        write_lines(lake.bronze, f"{n}.json", event(coin_id=coin, market_cap_usd=7 + n))
        build_lake(spark, lake, start="bronze")
    stored = dict(read_table(spark, lake.history).dtypes)
    assert stored["market_cap_usd"] == stored["total_volume_usd"] == "bigint"
    history = read_table(spark, lake.history, SILVER_SCHEMA)
    assert history.schema["market_cap_usd"].dataType.typeName() == "double"
    assert {r.coin_id: r.market_cap_usd for r in history.collect()} == {"b": 7.0, "c": 8.0}


def test_replaced_days_leave_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    two = silver(spark, {}, {"event_time_ts": at("2024-01-02T00:00:00")})
    append_days(two, path)
    replace_days(two.where("dt = '2024-01-02'").withColumn("price_usd", F.lit(9.0)), path)
    got = {str(r.dt): r.price_usd for r in read_table(spark, path, SILVER_SCHEMA).collect()}
    assert got == {"2024-01-01": 1.0, "2024-01-02": 9.0}


def test_replace_table_is_whole_whatever_the_session_says(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        replace_table(silver(spark, {}), path, by_day=True)
        later = silver(spark, {"event_time_ts": at("2024-01-02T00:00:00")})
        replace_table(later, path, by_day=True)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [str(r.dt) for r in spark.read.parquet(path).collect()] == ["2024-01-02"]


def test_empty_tables_read_with_their_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(silver(spark, {}).where("false"), path, by_day=True)
    empty = read_table(spark, path, SILVER_SCHEMA)
    assert empty.columns == SILVER_SCHEMA.fieldNames() and empty.count() == 0


def test_partition_filters_prune_folders(spark, lake):
    for n, lines in enumerate(deliveries(2)):
        write_lines(lake.bronze, f"{n}.json", *lines)
    start_history(stream_events(spark, lake.bronze), lake, available_now=True).awaitTermination()
    one_day = in_days(read_table(spark, lake.history, SILVER_SCHEMA), [(day("2024-01-02"),) * 2])
    plan = plan_of(one_day)
    assert "PartitionFilters: [isnotnull(dt" in plan or "PartitionFilters: [(dt" in plan
    assert [r.dt for r in one_day.collect()] == [at("2024-01-02").date()] * 8


def write_records(lake, name, *values):
    folder = Path(lake.records)
    folder.mkdir(parents=True, exist_ok=True)
    rows = [{"key": "k", "value": v, "partition": 0} for v in values]
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def topic(spark, lake):
    return spark.readStream.schema("key string, value string, partition int").json(lake.records)


def test_landing_keeps_readable_records_and_rejects_the_others(spark, lake):
    pretty = json.dumps(event(coin_id="b", name="two\nlines"), indent=2)
    values = [json.dumps(event(coin_id="a")), pretty, "oops {", None, ""]
    write_records(lake, "0.json", *values)
    start_landing(topic(spark, lake), lake, available_now=True).awaitTermination()
    start_rejects(topic(spark, lake), lake, available_now=True).awaitTermination()
    events = read_events(spark, lake.bronze)
    assert sorted((r.coin_id, r["name"]) for r in events.collect()) == [
        ("a", "A"),
        ("b", "two\nlines"),
    ]
    assert (Path(lake.bronze) / "partition=0").is_dir()
    rejected = spark.read.parquet(lake.path("quarantine/topic"))
    assert sorted(map(repr, (r.value for r in rejected.collect()))) == ["''", "'oops {'", "None"]


def test_files_are_cut_at_a_number_of_records(spark, lake):
    write_records(lake, "0.json", *[json.dumps(event(coin_id=f"c{n}")) for n in range(230)])
    start_landing(
        topic(spark, lake), lake, available_now=True, records_per_file=50
    ).awaitTermination()
    files = [f for f in Path(lake.bronze, "partition=0").iterdir() if f.suffix == ".txt"]
    assert sorted(len(f.read_text().splitlines()) for f in files) == [30, 50, 50, 50, 50]


def test_whole_chain_from_pages(spark, lake):
    for n in range(2):
        page = [
            {
                "id": coin,
                "symbol": coin,
                "name": coin.upper(),
                "current_price": 1.0 + n,
                "market_cap": 5,
                "total_volume": 6,
                "last_updated": "2024-01-01T00:00:00Z",
            }
            for coin in ("a", "b", "c")
        ]
        folder = Path(lake.pages) / f"polled_at=20240101T0{n}0000.000000Z" / f"run_id=r{n}"
        folder.mkdir(parents=True)
        (folder / "page.json").write_text(json.dumps(page))
    chosen = replace(lake, coin_ids=("a", "b"))
    for _run in range(2):
        build_lake(spark, chosen)
    quotes = read_table(spark, lake.quotes, GOLD_QUOTES_SCHEMA).collect()
    assert sorted((r.coin_id, str(r.event_time_ts), r.price_usd) for r in quotes) == [
        ("a", "2024-01-01 00:00:00", 1.0),
        ("a", "2024-01-01 01:00:00", 2.0),
        ("b", "2024-01-01 00:00:00", 1.0),
        ("b", "2024-01-01 01:00:00", 2.0),
    ]
    runs = read_table(spark, lake.history).select("ingestion_run_id").distinct().collect()
    assert sorted(r.ingestion_run_id for r in runs) == ["r0", "r1"]
    assert read_table(spark, lake.snapshot).count() == 2


def test_a_copied_page_gives_the_same_events(spark, lake, tmp_path):
    page = json.dumps([{"id": "a", "current_price": 1.0}])
    events = []
    for root in ("one", "two"):
        folder = tmp_path / root / "polled_at=20240101T000000.000000Z"
        folder.mkdir(parents=True)
        (folder / "p 1+.json").write_text(page)
        os.utime(folder / "p 1+.json", (1_700_000_000 + len(events),) * 2)
        events.append(poll_events(read_pages(spark, str(tmp_path / root)), lake).collect())
    assert events[0] == events[1] and events[0][0].event_time == "2024-01-01T00:00:00.000000+00:00"


def test_a_page_that_tells_no_time(spark, lake, tmp_path):
    (tmp_path / "p.json").write_text('[{"id": "a"}]')
    os.utime(tmp_path / "p.json", (1_704_067_200,) * 2)
    pages = read_pages(spark, str(tmp_path))
    assert poll_events(pages, lake).first().event_time is None
    by_file = poll_events(pages, lake, by_file_time=True).first()
    assert by_file.event_time == "2024-01-01T00:00:00.000000+00:00" and by_file.ingestion_run_id


def test_polls_report_what_they_sent(spark, lake):
    folder = Path(lake.pages) / "polled_at=20240101T000000.000000Z"
    folder.mkdir(parents=True)
    (folder / "p.json").write_text('[{"id": "a"}, {"id": "b"}]')
    query = start_polls(stream_pages(spark, lake.pages), lake, lake.records, available_now=True)
    query.awaitTermination()
    assert sum(p["observedMetrics"]["polls"]["sent"] for p in query.recentProgress if p["observedMetrics"]) == 2


def test_unknown_start_is_refused(spark, lake):
    with pytest.raises(ValueError, match="start"):
        build_lake(spark, lake, start="somewhere")


def test_continuous_queries_keep_the_whole_lake(spark, lake):
    lake = replace(lake, poll_seconds=1, serve_seconds=1)
    files = deliveries(3)
    write_records(lake, "0.json", *as_values(files[0]))
    queries = start_lake(spark, lake, topic(spark, lake))
    try:
        for n, lines in enumerate(files):
            write_records(lake, f"{n}.json", *as_values(lines))
            for query in queries:
                query.processAllAvailable()
        # What one query wrote last, the next may see one interval later.
        for query in queries[1:]:
            query.processAllAvailable()
    finally:
        for query in queries:
            query.stop()
    assert tables(spark, lake) == batch_results(spark, lake)
    assert read_table(spark, lake.snapshot).count() == 2


def as_values(lines):
    return [line if isinstance(line, str) else json.dumps(line) for line in lines]


def test_serving_equals_batch_and_survives_a_cut_off_replace(spark, lake):
    files = deliveries()
    for n, lines in enumerate(files[:3]):
        write_lines(lake.bronze, f"{n}.json", *lines)

    def serve():
        events = stream_events(spark, lake.bronze)
        start_history(events, lake, available_now=True).awaitTermination()
        start_serving(spark, lake, available_now=True, files_per_batch=4).awaitTermination()

    serve()
    for n, lines in enumerate(files[3:], 3):
        write_lines(lake.bronze, f"{n}.json", *lines)
    serve()
    expected = batch_results(spark, lake)
    assert tables(spark, lake) == expected

    # A driver lost while it replaced days: one is gone, the batch not committed.
    shutil.rmtree(Path(lake.latest) / "dt=2024-01-02")
    uncommit(lake, "serving")
    serve()
    assert tables(spark, lake) == expected


def test_latest_reads_history_once_and_then_only_new_rows(spark, lake):
    """After the first batch the merge no longer needs the old history."""
    write_lines(lake.bronze, "0.json", *deliveries(1)[0])
    run = {"available_now": True}
    start_history(stream_events(spark, lake.bronze), lake, **run).awaitTermination()
    start_latest(spark, lake, **run).awaitTermination()
    first = set(Path(lake.history).rglob("*.parquet"))
    write_lines(lake.bronze, "1.json", event(coin_id="c", event_time="2024-01-01T07:00:00Z"))
    start_history(stream_events(spark, lake.bronze), lake, **run).awaitTermination()
    for file in first:
        file.write_bytes(b"not parquet any more")
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    start_latest(spark, lake, **run).awaitTermination()
    latest = read_table(spark, lake.latest, SILVER_SCHEMA).collect()
    assert len(latest) == 7 and {r.coin_id for r in latest} == {"a", "b", "c"}


def test_quarantine_stream_takes_each_file_once(spark, lake):
    write_lines(lake.bronze, "0.json", "broken", event())
    for _run in range(2):
        events = stream_events(spark, lake.bronze)
        start_quarantine(events, lake, available_now=True).awaitTermination()
    assert spark.read.parquet(lake.quarantine).count() == 1


def test_runs_from_the_command_line(spark, lake, monkeypatch, capsys):
    monkeypatch.setenv("LAKE_ROOT", lake.root)
    monkeypatch.setenv("GOLD_FRESHNESS_MAX_LAG_MINUTES", str(10**9))
    for n, lines in enumerate(deliveries(2)):
        write_lines(lake.bronze, f"{n}.json", *lines)
    command_line(["silver"])
    assert spark.read.parquet(lake.quarantine).count() > 0
    command_line(["gold", "--days", "2024-01-02"])
    assert {str(r.dt) for r in read_table(spark, lake.daily, GOLD_DAILY_SCHEMA).collect()} == {
        "2024-01-02"
    }
    command_line(["lake"])
    assert tables(spark, lake) == batch_results(spark, lake)
    assert f"written: {lake.snapshot}" in capsys.readouterr().out
