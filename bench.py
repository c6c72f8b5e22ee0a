"""Times the headline queries; prints one JSON line.

Settings: BENCH_SF_DIR (folder of the tables), BENCH_CPUS, BENCH_RUNS. With
``--rows N`` the ranking operators and a gold run are also timed over a made
history of so many quotes, a third of them of one coin.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from quotelake.config import LakeConfig  # noqa: E402
from quotelake.operators import current_snapshot, dedup_quotes, latest_per_day  # noqa: E402
from quotelake.plans import build_gold, build_lake  # noqa: E402
from quotelake.schemas import SILVER_SCHEMA  # noqa: E402
from quotelake.session import SESSION_SETTINGS, scratch_path  # noqa: E402
from quotelake.sinks import append_days, replace_days  # noqa: E402
from quotelake.sources import read_table  # noqa: E402
from suite import tables  # noqa: E402
from suite.queries import QUERIES  # noqa: E402

HEADLINE = [
    "daily_metrics",
    "daily_metrics_lines",
    "dedup_quotes",
    "dedup_quotes_lines",
    "silver_latest",
    "silver_latest_lines",
    "gold_snapshot",
    "gold_snapshot_lines",
    "topn_page",
    "topn_page_deep",
    "silver_clean",
    "dq_null_counts",
    "dq_freshness",
    "src_json_lines",
    "sink_gold_quotes",
    "stream_silver_history",
    "stream_silver_latest",
    "stream_gold_daily",
    "flow_silver",
    "flow_gold",
    "flow_end_to_end",
]


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("quotelake-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
    )
    for name, value in SESSION_SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(work, runs: int) -> float:
    """Median of ``runs`` timed runs after one that warms up."""
    times = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        work()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 3)


def made_history(spark: SparkSession, lake: LakeConfig, rows: int) -> None:
    """A history of so many quotes over thirty days, a third of them of one coin."""
    number = F.col("id")
    coin = F.when(number % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.pmod(F.xxhash64("id"), F.lit(1000))))
    second = F.pmod(F.xxhash64(number, F.lit(1)), F.lit(30 * 86_400))
    base = {
        "event_time_ts": F.timestamp_seconds(F.lit(1_704_067_200) + second),
        "coin_id": coin,
        "price_usd": (number % 1000 + 1).cast("double"),
        "market_cap_usd": number.cast("double"),
        "total_volume_usd": number.cast("double"),
        "market_cap_rank": (number % 50).cast("int"),
        "ingestion_run_id": number.cast("string"),
    }
    quotes = spark.range(rows).withColumns(base).withColumn("dt", F.to_date("event_time_ts"))
    fill = {"symbol": "coin_id", "name": "coin_id", "last_updated_ts": "event_time_ts", "ingestion_time": "event_time_ts"}
    columns = [
        F.col(fill.get(f.name, f.name)).alias(f.name)
        if fill.get(f.name, f.name) in quotes.columns
        else F.lit("usd" if f.dataType.typeName() == "string" else 0).cast(f.dataType).alias(f.name)
        for f in SILVER_SCHEMA
    ]
    append_days(quotes.select(*columns), lake.history)


def large(spark: SparkSession, rows: int) -> dict[str, float]:
    """Single runs over a made history: all of gold, and the ranking operators."""
    lake = LakeConfig(root=scratch_path(spark, "bench-large"), max_lag_minutes=10**9)
    made_history(spark, lake, rows)
    history = read_table(spark, lake.history, SILVER_SCHEMA)
    replace_days(latest_per_day(history), lake.latest)

    def once(work) -> float:
        start = time.perf_counter()
        work()
        return round(time.perf_counter() - start, 1)

    def noop(operator) -> float:
        return once(lambda: operator(history).write.format("noop").mode("overwrite").save())

    found = {f"{operator.__name__}_{rows}": noop(operator) for operator in (dedup_quotes, latest_per_day, current_snapshot)}
    found[f"build_gold_{rows}"] = once(lambda: build_gold(spark, lake))
    return found


def incremental(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    """A chain's first run, one with late rows for every day, one with nothing new."""
    lake = LakeConfig(root=scratch_path(spark, "bench-chain"), max_lag_minutes=10**9)
    records = tables.topic_records(spark, sf_dir, faulty=True)
    deliveries = {"first": F.col("event_id") % 10 != 1, "late": F.col("event_id") % 10 == 1, "nothing": F.lit(False)}
    found = {}
    for name, chosen in deliveries.items():
        tables.write_lines(records.where(chosen), lake.bronze)
        start = time.perf_counter()
        build_lake(spark, lake, start="bronze")
        found[f"chain_{name}"] = round(time.perf_counter() - start, 3)
    return found


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session()

    def run(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    # The first queries of a session pay for loading and compiling classes.
    for name in HEADLINE[:4] * 2:
        run(name)
    timed = {name: seconds(lambda: run(name), runs) for name in HEADLINE}
    line = {
        "metric": "headline queries, sum of medians",
        "value": round(sum(timed.values()), 3),
        "unit": "sec",
        "queries": timed,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": spark.sparkContext.defaultParallelism,
        "runs": runs,
    }
    line["incremental"] = incremental(spark, sf_dir)
    if "--rows" in sys.argv[1:]:
        line["large"] = large(spark, int(sys.argv[sys.argv.index("--rows") + 1]))
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
