"""Latest rows, pages of a ranking and daily metrics against plain Python."""

from __future__ import annotations

import gc
import weakref
from datetime import timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quotelake.operators import (
    current_snapshot,
    daily_metrics,
    dedup_quotes,
    keep_latest,
    latest_per_day,
    ranked_page,
)
from quotelake.operators import latest
from quotelake.plans.gold import gold_quotes
from quotelake.session import remove_scratch, scratch_path
from tests.conftest import at, plan_of, rows_of, silver

START = at("2024-01-01T00:00:00")

QUOTE = st.fixed_dictionaries(
    {
        "coin_id": st.sampled_from("abc"),
        "event_time_ts": st.integers(0, 60).map(lambda h: START + timedelta(hours=h)),
        "last_updated_ts": st.one_of(
            st.none(), st.integers(0, 3).map(lambda m: START + timedelta(minutes=m))
        ),
        "price_usd": st.sampled_from([1.0, 2.0, 3.0]),
    }
)


def brute_latest(rows, keys, order):
    """The greatest row per key, nulls least, ties by the other columns."""
    rest = [c for c in rows[0].__fields__ if c not in (*keys, *order)] if rows else []
    best = {}
    for row in rows:
        rank = tuple((row[c] is not None, row[c] or 0) for c in (*order, *rest))
        key = tuple(row[c] for c in keys)
        if key not in best or rank > best[key][0]:
            best[key] = (rank, row)
    return sorted((tuple(row) for _, row in best.values()), key=repr)


@settings(
    max_examples=15,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(quotes=st.lists(QUOTE, min_size=1, max_size=40), parts=st.integers(1, 5))
def test_latest_equals_brute_force(spark, quotes, parts):
    table = silver(spark, *quotes).repartition(parts)
    rows = table.collect()
    for operator, keys, order in (
        (latest_per_day, ("dt", "coin_id"), ("event_time_ts", "last_updated_ts")),
        (current_snapshot, ("coin_id",), ("event_time_ts", "last_updated_ts")),
        (dedup_quotes, ("dt", "coin_id", "event_time_ts"), ("last_updated_ts",)),
    ):
        once = operator(table)
        got = sorted(map(tuple, once.collect()), key=repr)
        assert got == brute_latest(rows, keys, (*order, "ingestion_time"))
        assert sorted(map(tuple, operator(once).collect()), key=repr) == got


def test_newer_update_wins_and_null_update_loses(spark):
    quotes = silver(
        spark,
        {"price_usd": 1.0, "last_updated_ts": None},
        {"price_usd": 2.0, "last_updated_ts": at("2024-01-01T00:00:01")},
        {"price_usd": 3.0, "last_updated_ts": at("2024-01-01T00:00:00")},
    )
    assert [r.price_usd for r in dedup_quotes(quotes).collect()] == [2.0]


def test_later_ingestion_breaks_ties(spark):
    quotes = silver(
        spark,
        {"price_usd": 9.0, "ingestion_time": at("2024-02-01")},
        {"price_usd": 1.0, "ingestion_time": at("2024-02-02")},
    )
    assert [r.price_usd for r in dedup_quotes(quotes).collect()] == [1.0]


def test_exact_duplicates_collapse(spark):
    assert dedup_quotes(silver(spark, {}, {}, {})).count() == 1


def test_currencies_collapse_unless_keyed(spark):
    quotes = silver(spark, {"vs_currency": "usd"}, {"vs_currency": "eur"})
    assert latest_per_day(quotes).count() == 1
    assert latest_per_day(quotes, keys=("dt", "coin_id", "vs_currency")).count() == 2


def test_hot_key_is_cut_before_the_shuffle(spark):
    """A third of all rows in one group: each input task passes on one of them."""
    hot = (
        spark.range(0, 30_000, 1, 8)
        .select(
            F.lit("2024-01-01").cast("date").alias("dt"),
            F.when(F.col("id") % 3 == 0, "hot")
            .otherwise(F.concat(F.lit("c"), F.col("id").cast("string")))
            .alias("coin_id"),
            F.timestamp_seconds(F.col("id")).alias("event_time_ts"),
        )
    )
    latest = keep_latest(hot, ["dt", "coin_id"], ["event_time_ts"])
    assert latest.count() == 20_001
    assert latest.where("coin_id = 'hot'").select(F.unix_seconds("event_time_ts")).first()[0] == 29997
    plan = plan_of(latest)
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("page, per_page", [(1, 3), (2, 3), (40, 30), (1, 1001), (300, 7)])
@pytest.mark.parametrize("keys", [[], ["g"]])
def test_pages_equal_slices_of_the_sorted_list(spark, page, per_page, keys):
    rows = (
        spark.range(0, 6000, 1, 7)
        .select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 2 + 2).alias("g"), "id")
        .withColumn("x", F.pmod(F.xxhash64("id"), F.lit(500)))
    )
    got = ranked_page(
        rows, [F.desc("x"), F.asc("id")], page=page, per_page=per_page, keys=keys
    ).collect()
    groups = {}
    for r in rows.collect():
        groups.setdefault(r.g if keys else 0, []).append(r)
    want = set()
    for members in groups.values():
        ordered = sorted(members, key=lambda r: (-r.x, r.id))
        want |= {r.id for r in ordered[(page - 1) * per_page : page * per_page]}
    assert {r.id for r in got} == want and len(got) == len(want)


def test_deep_pages_of_a_table_sort_it_once(spark, monkeypatch):
    monkeypatch.setattr(latest, "SORTED_LIMIT_ROWS", 5)
    made = []
    monkeypatch.setattr(latest, "scratch_path", lambda *args: made.append(scratch_path(*args)) or made[-1])
    rows = spark.range(0, 100, 1, 3).select("id", (F.col("id") % 4).alias("x"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("y"))
    twice = rows.union(rows).where("true")
    orders = [[F.desc("x")], [F.asc("x")], [F.desc("x"), F.asc_nulls_first("y")], [F.desc(F.lit("x"))]]
    for number, order in enumerate(orders, 1):
        pages = [ranked_page(twice, order, page=n, per_page=70).collect() for n in (1, 2, 3, 4)]
        assert [len(page) for page in pages] == [70, 70, 60, 0] and len(made) == number
        got = [row for page in pages for row in page]
        assert sorted(map(repr, got)) == sorted(map(repr, twice.collect()))
        want = twice.orderBy(*latest.total_order(twice.columns, order)).collect()
        assert [sorted(map(repr, page)) for page in pages] == [sorted(map(repr, want[at : at + 70])) for at in (0, 70, 140, 210)]
    # Another DataFrame is sorted on its own, and the slices are forgotten with theirs.
    assert ranked_page(twice.where("x > 0"), [F.desc("x")], page=2, per_page=70).count() == 70 and len(made) == 5
    remove_scratch()
    assert ranked_page(twice, [F.desc("x")], page=3, per_page=70).count() == 60 and len(made) == 6
    held = weakref.ref(twice)
    del twice
    gc.collect()
    assert held() is None


def test_page_numbers_start_at_one(spark):
    with pytest.raises(ValueError):
        ranked_page(spark.range(3), [F.asc("id")], page=0)


def test_daily_metrics_values(spark):
    quotes = silver(
        spark,
        {"price_usd": 4.0, "event_time_ts": at("2024-01-01T01:00:00"), "market_cap_usd": 90.0},
        {"price_usd": 1.0, "event_time_ts": at("2024-01-01T03:00:00")},
        {"price_usd": 7.0, "event_time_ts": at("2024-01-01T02:00:00")},
        {"price_usd": 2.0, "event_time_ts": at("2024-01-02T00:00:00")},
        {"price_usd": 5.0, "event_time_ts": at("2024-01-01T05:00:00"), "name": "renamed"},
    )
    rows = {(str(r.dt), r["name"]): r for r in daily_metrics(quotes).collect()}
    assert len(rows) == 3
    first = rows["2024-01-01", "A"]
    assert (first.avg_price_usd, first.min_price_usd, first.max_price_usd) == (4.0, 1.0, 7.0)
    assert (first.last_price_usd, first.max_market_cap_usd) == (1.0, 90.0)
    assert rows["2024-01-01", "renamed"].last_price_usd == 5.0


def test_last_price_on_a_time_tie_is_the_greater_one(spark):
    quotes = silver(spark, {"price_usd": 3.0}, {"price_usd": 8.0}, {"price_usd": 5.0})
    assert daily_metrics(quotes).first().last_price_usd == 8.0


def test_both_last_price_forms_agree_without_ties(spark):
    quotes = dedup_quotes(
        silver(
            spark,
            *[
                {"price_usd": float(n * 7 % 11), "event_time_ts": START + timedelta(hours=n)}
                for n in range(60)
            ],
            {"price_usd": None, "event_time_ts": START + timedelta(hours=70)},
        )
    )
    assert rows_of(daily_metrics(quotes)) == rows_of(daily_metrics(quotes, unique_times=True))


@pytest.mark.parametrize("drop", [[], ["name", "symbol"], ["price_change_percentage_24h", "source"]])
def test_columns_dropped_afterwards_do_not_change_the_winner(spark, drop):
    rows = silver(
        spark,
        *[
            {"ingestion_run_id": run, "price_usd": price, "source_file": file}
            for run, price, file in (("r1", 9.0, "f"), ("r2", 1.0, "f"), ("r2", 5.0, "e"))
        ],
    )
    for operator in (dedup_quotes, latest_per_day, current_snapshot):
        whole = operator(rows).drop(*drop)
        assert rows_of(whole) == rows_of(operator(rows.drop(*drop)))
        assert whole.first().price_usd == 1.0
    assert gold_quotes(rows).first().price_usd == 1.0
