"""The physical plans that make the operators hold at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from quotelake.operators import daily_metrics, dedup_quotes, latest_per_day, ranked_page
from quotelake.plans.gold import gold_quotes
from quotelake.schemas import SILVER_SCHEMA
from quotelake.session import use_settings
from quotelake.sinks import append_days
from quotelake.sinks.tables import cluster_by_day
from suite import queries, tables
from tests.conftest import plan_of

LAZY = [
    name
    for name in queries.QUERIES
    if name.split("_")[0] in ("norm", "filter", "topn", "silver", "dedup", "gold", "daily")
]


@pytest.fixture(scope="module")
def history(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("history"))
    append_days(tables.event_quotes(spark, sf_dir).select(*SILVER_SCHEMA.fieldNames()), path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join_in_any_plan(spark, sf_dir, name):
    plan = plan_of(queries.QUERIES[name](spark, sf_dir))
    assert not re.search(r"Python|ArrowEval|MapInPandas|Cartesian|NestedLoop", plan)


@pytest.mark.parametrize("operator", [latest_per_day, dedup_quotes])
def test_groups_are_cut_on_both_sides_of_one_shuffle(history, operator):
    plan = plan_of(operator(history))
    limits = re.findall(r"WindowGroupLimit .*?, (Partial|Final)\n", plan)
    assert limits == ["Final", "Partial"]
    assert plan.count("Exchange") == 1


def test_daily_metrics_hash_and_combine_before_the_shuffle(history):
    plan = plan_of(daily_metrics(history, unique_times=True))
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan
    assert "partial_max_by" in plan


def test_only_needed_columns_are_read(history):
    plan = plan_of(daily_metrics(history, unique_times=True))
    assert "price_usd" in plan and "source_file" not in plan and "market_cap_rank" not in plan
    # Lineage decides between ties and is not published.
    assert "source_file" in plan_of(gold_quotes(history))
    assert "source_file" not in gold_quotes(history).columns


def test_keyed_pages_of_any_depth_are_one_plan(spark, history):
    use_settings(spark)
    for page in (1, 24, 4000):
        plan = plan_of(ranked_page(history, [F.desc("price_usd")], page=page, per_page=50, keys=["coin_id"]))
        assert re.findall(r"WindowGroupLimit .*?, (Partial|Final)\n", plan) == ["Final", "Partial"]
        assert plan.count("Exchange") == 1


def test_a_deep_page_without_keys_is_in_no_single_task(spark, sf_dir):
    plan = plan_of(queries.topn_page_global_deep(spark, sf_dir))
    assert "Exchange" not in plan and re.search(r"PartitionFilters: \[[^]]*_slice", plan)


def test_day_filters_reach_the_partitions_through_the_window(history):
    plan = plan_of(latest_per_day(history).where(F.col("dt") == "2024-01-05"))
    assert re.search(r"PartitionFilters: \[isnotnull\(dt.*?2024-01-05", plan)


def test_coin_filters_reach_the_row_groups(history):
    plan = plan_of(latest_per_day(history).where(F.col("coin_id") == "click"))
    assert re.search(r"PushedFilters: \[.*EqualTo\(coin_id,click\)", plan)


def test_writes_gather_days_so_that_a_hot_day_can_be_split(history):
    assert "REBALANCE_PARTITIONS_BY_COL" in plan_of(cluster_by_day(history))


def test_a_hot_day_is_split_over_several_files(spark, tmp_path):
    rows = spark.range(0, 400_000, 1, 8).select(
        F.xxhash64("id").alias("x"),
        F.when(F.col("id") % 10 < 9, F.lit("2024-01-01").cast("date"))
        .otherwise(F.date_add(F.lit("2024-01-02").cast("date"), (F.col("id") % 20).cast("int")))
        .alias("dt"),
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size, None)
    spark.conf.set(size, "256k")
    try:
        append_days(rows, str(tmp_path / "t"))
    finally:
        spark.conf.set(size, before) if before else spark.conf.unset(size)
    hot = list((tmp_path / "t" / "dt=2024-01-01").glob("*.parquet"))
    assert len(hot) > 4
    assert spark.read.parquet(str(tmp_path / "t")).count() == 400_000
