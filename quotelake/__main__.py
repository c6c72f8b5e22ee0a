"""Runs from the command line, with settings from the environment.

    python -m quotelake silver
    python -m quotelake gold
    python -m quotelake gold --days 2024-01-01 2024-01-02
    spark-submit --py-files quotelake.zip lake_job.py lake --start bronze
    spark-submit --packages <Kafka connector> --py-files quotelake.zip lake_job.py serve
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date

from pyspark.sql import SparkSession

from quotelake.config import LakeConfig
from quotelake.plans import build_gold, build_lake, build_silver, update_gold
from quotelake.session import build_session
from quotelake.sinks import publish_stream
from quotelake.sources import stream_pages, stream_topic
from quotelake.streaming import RunLog, poll_events, start_lake, start_landing, start_rejects

SILVER = ("history", "latest")
GOLD = ("quotes", "daily", "snapshot")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="quotelake", description=__doc__.splitlines()[0])
    jobs = top.add_subparsers(dest="job", required=True)
    silver = jobs.add_parser("silver", help="new bronze files to history and latest rows")
    gold = jobs.add_parser("gold", help="checked quotes, daily metrics and snapshot")
    gold.add_argument("--days", nargs="+", type=date.fromisoformat, help="make these days anew")
    lake = jobs.add_parser("lake", help="every stage, over what is new")
    lake.add_argument("--start", choices=["pages", "records", "bronze"], default="bronze")
    land = jobs.add_parser("land", help="the topic to bronze files, until stopped")
    serve = jobs.add_parser("serve", help="the topic to all tables, until stopped")
    publish = jobs.add_parser("publish", help="landed pages to the topic, until stopped")
    publish.add_argument("--by-file-time", action="store_true", help="for paths that tell no poll time")
    for job in (gold, lake):
        job.add_argument("--full", action="store_true", help="make all days anew")
    for job in (silver, lake, land, serve):
        job.add_argument("--no-quarantine", action="store_true", help="drop records that are left out")
    return top


def run_topic_job(spark: SparkSession, config: LakeConfig, chosen: argparse.Namespace) -> None:
    """A job that reads or writes the topic; it runs until it is stopped, and is logged."""
    with RunLog(spark, config):
        if chosen.job == "publish":
            pages = stream_pages(spark, config.pages, files_per_batch=config.files_per_batch)
            events = poll_events(pages, config, by_file_time=chosen.by_file_time)
            checkpoint = config.checkpoint("publish")
            publish_stream(
                events, config.servers, config.topic, checkpoint, poll_seconds=config.poll_seconds
            )
        else:
            records = stream_topic(spark, config.servers, config.topic)
            keep = not chosen.no_quarantine
            if chosen.job == "serve":
                start_lake(spark, config, records, quarantine=keep)
            else:
                start_landing(records, config)
                if keep:
                    start_rejects(records, config)
        spark.streams.awaitAnyTermination()


def main(arguments: Sequence[str] | None = None) -> None:
    chosen = parser().parse_args(arguments)
    config = LakeConfig.from_env()
    spark = build_session(f"quotelake-{chosen.job}")
    written: tuple[str, ...] = ()
    if chosen.job == "silver":
        build_silver(spark, config, quarantine=not chosen.no_quarantine)
        written = SILVER
    elif chosen.job == "gold":
        if chosen.full or chosen.days:
            build_gold(spark, config, days=chosen.days)
        else:
            update_gold(spark, config)
        written = GOLD
    elif chosen.job == "lake":
        build_lake(
            spark,
            config,
            start=chosen.start,
            quarantine=not chosen.no_quarantine,
            full=chosen.full,
        )
        written = GOLD
    else:
        run_topic_job(spark, config, chosen)
    for table in written:
        print(f"written: {getattr(config, table)}")


if __name__ == "__main__":
    main()
