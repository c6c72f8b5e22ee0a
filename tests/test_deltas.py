from __future__ import annotations

import random
from dataclasses import replace
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quotelake.operators import QualityError, daily_metrics
from quotelake.plans import build_gold, delta, update_gold
from quotelake.plans.delta import read_state, read_winners
from quotelake.plans.gold import gold_quotes
from quotelake.schemas import GOLD_DAILY_SCHEMA, GOLD_QUOTES_SCHEMA
from quotelake.sinks import append_days, replace_days
from quotelake.sources import read_table
from tests.conftest import at, rows_of, silver


@pytest.fixture
def delta_lake(lake, spark):
    lake = replace(lake, gold_write="delta", delta_buckets=4)
    return lake


def deliver(spark, lake, *rows: dict) -> None:
    quotes = silver(spark, *rows)
    append_days(quotes, lake.history)
    replace_days(quotes, lake.latest)
    update_gold(spark, lake)


def compared(daily, quotes) -> tuple[list, list]:
    """All values as they are, averages to twelve digits: sums of doubles depend on their order."""
    daily = daily.withColumn("avg_price_usd", F.format_string("%.11e", "avg_price_usd"))
    return rows_of(daily), rows_of(quotes)


def whole(spark, lake) -> tuple[list, list]:
    """Daily metrics and quotes as a run over all of history makes them."""
    quotes = gold_quotes(read_table(spark, lake.history))
    return compared(daily_metrics(quotes), quotes)


def kept(spark, lake) -> tuple[list, list]:
    return compared(read_table(spark, lake.daily, GOLD_DAILY_SCHEMA), read_table(spark, lake.quotes, GOLD_QUOTES_SCHEMA))


def made(pick: random.Random, number: int) -> dict:
    """A quote that may correct an earlier one: few coins, days, times and prices."""
    time = at("2024-01-01T00:00:00") + timedelta(days=pick.randrange(3), hours=pick.randrange(4))
    coin = pick.choice("abcd")
    return {
        "event_time_ts": time,
        "last_updated_ts": None if pick.random() < 0.2 else time + timedelta(minutes=pick.randrange(50)),
        "ingestion_run_id": f"r{number:03}",
        "coin_id": coin,
        "symbol": coin,
        "name": pick.choice([coin.upper(), coin.upper(), "renamed"]),
        "price_usd": pick.choice([1.5, 0.1, 0.3, 1e-9, 7e11, 2.5]),
        "market_cap_usd": float(pick.randrange(5)),
        "total_volume_usd": float(pick.randrange(5)),
    }


@pytest.mark.parametrize("seed", range(2))
def test_late_corrections_equal_a_run_over_everything(spark, delta_lake, seed):
    pick = random.Random(seed)
    for delivery in range(3):
        deliver(spark, delta_lake, *[made(pick, 100 * delivery + n) for n in range((40, 1, 12)[delivery])])
        assert kept(spark, delta_lake) == whole(spark, delta_lake)


def test_prices_that_are_no_decimals(spark, delta_lake):
    base = {"event_time_ts": at("2024-01-01T01:00:00"), "last_updated_ts": at("2024-01-01T01:00:00")}
    later = {"event_time_ts": at("2024-01-01T02:00:00")}
    deliver(spark, delta_lake, {**base, "price_usd": float("nan")}, {**later, "price_usd": 2.0})
    assert kept(spark, delta_lake) == whole(spark, delta_lake)
    deliver(spark, delta_lake, {**base, "price_usd": 1e300, "last_updated_ts": at("2024-01-01T01:01:00")})
    assert kept(spark, delta_lake) == whole(spark, delta_lake)
    deliver(spark, delta_lake, {**base, "price_usd": 3.0, "last_updated_ts": at("2024-01-01T01:02:00")})
    assert kept(spark, delta_lake) == whole(spark, delta_lake)
    assert read_state(spark, delta_lake).first().odd_prices == 0


def files_of(path: str) -> dict[str, float]:
    return {str(file): file.stat().st_mtime_ns for file in Path(path).rglob("part-*")}


def test_one_coin_leaves_the_folders_of_others_and_history_alone(spark, delta_lake):
    rows = [{"coin_id": c, "event_time_ts": at(f"2024-01-0{d}T0{h}:00:00")} for c in "abcdefgh" for d in (1, 2) for h in (1, 2)]
    deliver(spark, delta_lake, *rows)
    before = files_of(delta_lake.quotes)
    # Nothing that was there may be needed again: of old history only the footers stay.
    for file in map(Path, files_of(delta_lake.history)):
        raw = file.read_bytes()
        rows_end = len(raw) - 8 - int.from_bytes(raw[-8:-4], "little")
        file.write_bytes(b"PAR1" + bytes(rows_end - 4) + raw[rows_end:])
    update = {"coin_id": "a", "event_time_ts": at("2024-01-01T01:00:00"), "price_usd": 9.0, "ingestion_run_id": "r2"}
    append_days(silver(spark, update), delta_lake.history)
    update_gold(spark, delta_lake)
    after = files_of(delta_lake.quotes)
    gone = {Path(file).parent for file in before if file not in after}
    assert len(gone) == 1 and all(before[file] == after[file] for file in before if file in after)
    daily = {(r.dt.day, r.coin_id): r for r in read_table(spark, delta_lake.daily, GOLD_DAILY_SCHEMA).collect()}
    assert len(daily) == 16 and daily[1, "a"].max_price_usd == 9.0 and daily[1, "a"].avg_price_usd == 5.0
    assert daily[1, "b"].max_price_usd == daily[2, "a"].max_price_usd == 1.0


@pytest.mark.parametrize("step", [0, 2])
def test_a_batch_that_fails_between_its_writes_counts_once(spark, delta_lake, monkeypatch, step):
    deliver(spark, delta_lake, {"price_usd": 1.0}, {"coin_id": "b"}, {"event_time_ts": at("2024-01-01T05:00:00"), "price_usd": 4.0})
    write, done = delta.replace_folders, []

    def failing(*args, **options):
        if len(done) == step:
            raise RuntimeError("lost")
        done.append(1)
        write(*args, **options)

    monkeypatch.setattr(delta, "replace_folders", failing)
    late = {"event_time_ts": at("2024-01-01T05:00:00"), "price_usd": 0.5, "ingestion_run_id": "r2"}
    with pytest.raises(Exception, match="lost"):
        deliver(spark, delta_lake, late, {"coin_id": "c"})
    monkeypatch.undo()
    update_gold(spark, delta_lake)
    assert kept(spark, delta_lake) == whole(spark, delta_lake)


def test_a_failed_check_publishes_nothing_and_names_the_reasons(spark, delta_lake):
    deliver(spark, delta_lake, {"price_usd": 1.0})
    before = kept(spark, delta_lake)
    with pytest.raises(QualityError) as failure:
        deliver(spark, delta_lake, {"coin_id": "b", "price_usd": -1.0, "symbol": None})
    assert failure.value.reasons == ["null_symbol", "price_usd_null_or_non_positive"]
    assert kept(spark, delta_lake) == before


def test_freshness_is_that_of_all_quotes(spark, delta_lake):
    deliver(spark, delta_lake, {"event_time_ts": at("2024-01-05T00:00:00")})
    strict = replace(delta_lake, max_lag_minutes=60)
    append_days(silver(spark, {"event_time_ts": at("2024-01-01T00:00:00")}), strict.history)
    update_gold(spark, strict, as_of=F.lit(at("2024-01-05T00:30:00")))
    assert len(kept(spark, strict)[1]) == 2
    append_days(silver(spark, {"event_time_ts": at("2024-01-02T00:00:00")}), strict.history)
    with pytest.raises(QualityError, match="freshness_lag_minutes=90.0"):
        update_gold(spark, strict, as_of=F.lit(at("2024-01-05T01:30:00")))


def test_quotes_already_there_change_nothing(spark, delta_lake):
    rows = [{"coin_id": c} for c in "ab"]
    deliver(spark, delta_lake, *rows)
    before = files_of(delta_lake.daily)
    deliver(spark, delta_lake, *rows)
    assert files_of(delta_lake.daily) == before and read_winners(spark, delta_lake).count() == 2


def test_a_whole_run_is_refused(spark, delta_lake):
    with pytest.raises(ValueError, match="update_gold"):
        build_gold(spark, delta_lake)


def test_missing_columns_are_a_quality_error(spark, lake, delta_lake):
    for each in (lake, delta_lake):
        silver(spark, {}).drop("symbol").write.partitionBy("dt").mode("overwrite").parquet(each.history)
        with pytest.raises(QualityError) as failure:
            update_gold(spark, each)
        assert failure.value.reasons == ["missing_columns:['symbol']"]


def test_days_without_rows_do_not_fail_freshness(spark, lake):
    quotes = silver(spark, {"event_time_ts": at("2024-01-02T00:00:00")})
    append_days(quotes, lake.history)
    replace_days(quotes, lake.latest)
    build_gold(spark, lake, days=[at("2024-01-02T00:00:00").date(), at("2024-02-02T00:00:00").date()])
    assert read_table(spark, lake.daily, GOLD_DAILY_SCHEMA).count() == 1
    build_gold(spark, lake, days=[at("2024-03-02T00:00:00").date()])


def test_old_history_that_cannot_be_read_stops_no_update(spark, delta_lake, monkeypatch):
    deliver(spark, delta_lake, {"price_usd": 1.0})
    read = delta.read_table

    def damaged(session, path, *schema):
        if path == delta_lake.history:
            raise PySparkException("CANNOT_READ_FILE_FOOTER")
        return read(session, path, *schema)

    monkeypatch.setattr(delta, "read_table", damaged)
    deliver(spark, delta_lake, {"coin_id": "b", "price_usd": 2.0})
    daily = read_table(spark, delta_lake.daily, GOLD_DAILY_SCHEMA).collect()
    assert sorted((r.coin_id, r.max_price_usd) for r in daily) == [("a", 1.0), ("b", 2.0)]
    with pytest.raises(QualityError, match="null_symbol"):
        deliver(spark, delta_lake, {"coin_id": "c", "symbol": None})
