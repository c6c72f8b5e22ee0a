"""Checks, their reason texts and the age of a table."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quotelake.functions import utc_literal
from quotelake.operators import (
    freshness,
    missing_columns,
    quality_failures,
    quality_report,
    quality_summary,
)
from quotelake.schemas import REQUIRED_COLUMNS
from tests.conftest import at, silver


def failures(quotes, max_lag=None, as_of="2024-01-01T01:00:00", **options):
    summary = quality_summary(quotes, as_of=utc_literal(at(as_of)), **options)
    return quality_failures(summary.first().asDict(), max_lag)


def test_sound_quotes_have_no_failures(spark):
    assert failures(silver(spark, {}), 60) == []


@pytest.mark.parametrize("column", REQUIRED_COLUMNS)
def test_each_null_has_its_reason(spark, column):
    first_day = at("2024-01-01").date()
    reasons = failures(silver(spark, {}, {"dt": first_day, column: None}))
    assert reasons[0] == f"null_{column}"
    assert (len(reasons) == 2) == (column == "price_usd")


@pytest.mark.parametrize("price", [None, 0.0, -1.0])
def test_price_has_to_be_positive(spark, price):
    assert "price_usd_null_or_non_positive" in failures(silver(spark, {"price_usd": price}))


def test_nan_passes_unless_rejected(spark):
    quotes = silver(spark, {"price_usd": float("nan")})
    assert failures(quotes) == []
    assert failures(quotes, reject_nan=True) == ["price_usd_nan"]


def test_all_reasons_come_together_in_order(spark):
    quotes = silver(spark, {"name": None, "symbol": None, "price_usd": -1.0})
    assert failures(quotes, 30) == [
        "null_symbol",
        "null_name",
        "price_usd_null_or_non_positive",
        "freshness_lag_minutes=60.0",
    ]


def test_lag_is_exact_and_the_limit_itself_passes(spark):
    quotes = silver(spark, {})
    assert failures(quotes, 60) == []
    assert failures(quotes, 60, as_of="2024-01-01T01:00:00.000001") == [
        "freshness_lag_minutes=60.0"
    ]


def test_lag_does_not_depend_on_the_session_zone(spark):
    quotes = silver(spark, {})
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = freshness(quotes, as_of=utc_literal(at("2024-01-01T02:00:00"))).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row.lag_minutes == 120.0


def test_an_empty_table_is_not_fresh(spark):
    assert failures(silver(spark, {}).where("false"), 60) == ["no_event_time_ts_found"]


def test_missing_columns_in_required_order(spark):
    quotes = silver(spark, {}).drop("vs_currency", "coin_id")
    assert missing_columns(quotes) == ["coin_id", "vs_currency"]


def test_report_counts_bad_rows(spark):
    quotes = silver(spark, {"name": None}, {"name": None, "price_usd": 0.0}, {})
    report = {r.check_name: r.bad_rows for r in quality_report(quotes).collect()}
    assert len(report) == len(REQUIRED_COLUMNS) + 1
    assert report["null_name"] == 2 and report["price_usd_null_or_non_positive"] == 1
    assert report["null_dt"] == 0


def test_all_checks_are_one_aggregate(spark):
    plan = quality_summary(silver(spark, {}).repartition(3))._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert text.count("HashAggregate") == 2 and "Window" not in text


def test_default_age_is_measured_from_now(spark):
    row = freshness(silver(spark, {}).withColumn("event_time_ts", F.current_timestamp())).first()
    assert abs(row.lag_minutes) < 1
