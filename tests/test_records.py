"""Kept rankings, check states, the log of runs, drift of fields."""

from __future__ import annotations

import random
from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from quotelake.operators import check_states, quality_summary, ranked_page, record_fields, schema_drift, states_summary
from quotelake.plans import indexed_page, write_rank_index
from quotelake.schemas import SILVER_SCHEMA
from quotelake.sinks import append_days
from quotelake.sources import read_table, stream_events
from quotelake.streaming import RunLog, checks, read_check_states, read_run_log, start_checks, start_history
from tests.conftest import at, event, plan_of, rows_of, silver, write_lines


def some_quotes(spark, seed: int, many: int):
    pick = random.Random(seed)
    rows = []
    for number in range(many):
        time = at("2024-01-01T00:00:00") + timedelta(days=pick.randrange(3), minutes=pick.randrange(50))
        price = pick.choice([None, -1.0, float("nan"), 2.0, 3.0, 3.0])
        rows.append({"event_time_ts": time, "coin_id": pick.choice(["a", "a", "a", "b", None]), "symbol": pick.choice("xy"), "price_usd": price, "market_cap_rank": number})
    return silver(spark, *rows)


# Kept rankings


@pytest.mark.parametrize("keys", [(), ("coin_id",), ("dt", "coin_id")])
def test_pages_of_a_kept_ranking_are_those_of_the_table(spark, tmp_path, keys):
    quotes = some_quotes(spark, 1, 120)
    index = write_rank_index(quotes, [F.desc("price_usd")], str(tmp_path / "index"), keys)
    seen = 0
    for page in range(1, 10):
        want = rows_of(ranked_page(quotes, [F.desc("price_usd")], page=page, per_page=17, keys=keys))
        assert rows_of(indexed_page(spark, index, page=page, per_page=17)) == want
        seen += len(want)
    assert seen == 120
    with pytest.raises(ValueError):
        indexed_page(spark, index, page=0)


def test_a_page_reads_the_slices_that_hold_it(spark, tmp_path):
    rows = spark.range(40_000).select((F.col("id") * 7919 % 40_000).alias("value"), F.lit("x" * 20).alias("text"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index = write_rank_index(rows, [F.asc("value")], str(tmp_path / "index"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    folders = sorted(Path(index.rows).glob("_slice=*"))
    assert len(folders) == 4
    # All other slices are made unreadable: the page does not look at them.
    page = indexed_page(spark, index, page=300, per_page=100)
    want = list(range(29_900, 30_000))
    holding = {row[0] for row in page.select(F.input_file_name()).distinct().collect()}
    assert len(holding) <= 2
    for folder in folders:
        if not any(f"/{folder.name}/" in name for name in holding):
            for file in folder.glob("part-*"):
                raw = file.read_bytes()
                end = len(raw) - 8 - int.from_bytes(raw[-8:-4], "little")
                file.write_bytes(b"PAR1" + bytes(end - 4) + raw[end:])
    assert sorted(row.value for row in page.collect()) == want
    assert "Exchange" not in plan_of(page) and "_slice" in plan_of(page)


def test_kept_ranking_of_an_empty_table(spark, tmp_path):
    empty = some_quotes(spark, 1, 3).limit(0)
    index = write_rank_index(empty, [F.desc("price_usd")], str(tmp_path / "index"), ["coin_id"])
    assert spark.read.schema("_slice int").parquet(index.rows).count() == 0


# Check states


def summary_of(df) -> dict:
    return df.first().asDict()


def test_states_equal_a_full_check_after_each_delivery(spark, lake):
    as_of = F.lit("2024-02-01 00:00:00").cast("timestamp")
    for seed in range(3):
        append_days(some_quotes(spark, seed, 15), lake.history)
        start_checks(spark, lake, available_now=True).awaitTermination()
        history = read_table(spark, lake.history, SILVER_SCHEMA)
        states = read_check_states(spark, lake)
        for reject_nan in (False, True):
            want = summary_of(quality_summary(history, as_of=as_of, reject_nan=reject_nan))
            assert summary_of(states_summary(states, as_of=as_of, reject_nan=reject_nan)) == want
        assert rows_of(states) == rows_of(check_states(history))


def test_states_are_merged_without_a_look_at_the_history(spark, lake):
    append_days(silver(spark, {"coin_id": "a"}, {"coin_id": None}), lake.history)
    start_checks(spark, lake, available_now=True).awaitTermination()
    for file in Path(lake.history).rglob("part-*"):
        raw = file.read_bytes()
        end = len(raw) - 8 - int.from_bytes(raw[-8:-4], "little")
        file.write_bytes(b"PAR1" + bytes(end - 4) + raw[end:])
    untouched = {str(file): file.stat().st_mtime_ns for file in Path(lake.check_states).rglob("part-*")}
    append_days(silver(spark, {"event_time_ts": at("2024-01-05T00:00:00")}), lake.history)
    start_checks(spark, lake, available_now=True).awaitTermination()
    got = {row.dt: (row.checked_rows, row.null_coin_id) for row in read_check_states(spark, lake).collect()}
    assert got == {date(2024, 1, 1): (2, 1), date(2024, 1, 5): (1, 0)}
    assert all(Path(file).stat().st_mtime_ns == time for file, time in untouched.items())


@pytest.mark.parametrize("failing_write", [1, 2, 3])
def test_states_count_once_after_a_failure(spark, lake, monkeypatch, failing_write):
    append_days(some_quotes(spark, 1, 9), lake.history)
    start_checks(spark, lake, available_now=True).awaitTermination()
    append_days(some_quotes(spark, 2, 9), lake.history)
    done = []

    def failing(write):
        def run(table, path, **options):
            done.append(path)
            if len(done) == failing_write:
                write(table.limit(1), path, **options)
                raise OSError("no more room")
            write(table, path, **options)

        return run

    with monkeypatch.context() as patch:
        patch.setattr(checks, "replace_table", failing(checks.replace_table))
        patch.setattr(checks, "replace_days", failing(checks.replace_days))
        with pytest.raises(StreamingQueryException):
            start_checks(spark, lake, available_now=True).awaitTermination()
    assert len(done) == failing_write
    if failing_write == 2:
        # Staging that is cut short does not count as written: it has no file then.
        for file in Path(lake.check_staging).rglob("merged/part-*"):
            file.unlink()
    start_checks(spark, lake, available_now=True).awaitTermination()
    assert rows_of(read_check_states(spark, lake)) == rows_of(check_states(read_table(spark, lake.history, SILVER_SCHEMA)))


# The log of runs


def test_log_tells_counts_of_batches_and_why_one_failed(spark, lake, monkeypatch):
    write_lines(lake.bronze, "1.json", event(), event(coin_id="b"), "no json")
    with RunLog(spark, lake, rows_per_file=1) as log:
        log.finish(log.watch(start_history(stream_events(spark, lake.bronze), lake, available_now=True), "history"))
        log.finish(log.watch(start_checks(spark, lake, available_now=True), "checks"))
        write_lines(lake.bronze, "2.json", event(coin_id="c"))
        log.finish(log.watch(start_history(stream_events(spark, lake.bronze), lake, available_now=True), "history"))

        def failing(table, path, **options):
            raise OSError("no more room")

        monkeypatch.setattr(checks, "replace_table", failing)
        with pytest.raises(StreamingQueryException):
            log.finish(log.watch(start_checks(spark, lake, available_now=True), "checks"))
    rows = read_run_log(spark, lake).collect()
    kept = {row.batch_id: row.counts["kept"] for row in rows if row.stream == "history"}
    assert kept == {0: 2, 1: 1}
    done, failed = (
        [row for row in rows if row.stream == "checks" and (row.failure is None) == good] for good in (True, False)
    )
    assert [(row.batch_id, row.input_rows) for row in done] == [(0, 2)]
    assert [row.batch_id for row in failed] == [1] and "no more room" in failed[0].failure
    # What is not watched any more, after the block, is not logged.
    start_history(stream_events(spark, lake.bronze), lake, available_now=True).awaitTermination()
    assert read_run_log(spark, lake).count() == len(rows)


# Drift


def test_kinds_of_fields_join_upwards(spark):
    day = date(2024, 1, 1)
    texts = ['{"a":1,"b":null,"c":[1]}', '{"a":1.5,"b":"x","c":{"d":1}}', '{"a":1e300,"e":null,"f":true}', "[1,2]", "no json", "", None, "{}"]
    records = spark.createDataFrame([(day, text) for text in texts], "day date, value string")
    got = {row.field: (row.kind, row.records, row.nulls) for row in record_fields(records, "value", "day").collect()}
    assert got == {
        "a": ("number", 3, 0), "b": ("text", 2, 1), "c": ("mixed", 2, 0), "e": ("null", 1, 1), "f": ("flag", 1, 0),
    }


def test_drift_is_against_the_last_day_with_records(spark):
    rows = [
        (1, '{"a":1,"b":"x","n":null}'), (2, '{"a":"1","b":"x","n":1}'), (5, '{"a":"1","z":null}'), (6, '{"a":null,"z":1}'),
        (7, "no json"), (8, '{"a":true,"z":2}'), (None, '{"q":1}'),
    ]
    days = [(day and date(2024, 1, day), text) for day, text in rows]
    records = spark.createDataFrame(days, "day date, value string")
    got = sorted((row.day.day, row.field, row.change, row.old_kind, row.new_kind) for row in schema_drift(record_fields(records, "value", "day")).collect())
    assert got == [
        (2, "a", "retyped", "number", "text"),
        (5, "b", "lost", "text", None),
        (5, "n", "lost", "number", None),
        (5, "z", "new", None, "null"),
    ]
    assert schema_drift(record_fields(records.limit(0), "value", "day")).collect() == []
