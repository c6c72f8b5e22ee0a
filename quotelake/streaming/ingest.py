"""Landed pages to topic records, and topic records to bronze files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quotelake.config import LakeConfig
from quotelake.functions import is_json
from quotelake.operators import filter_ids, keyed_json, pages_to_events
from quotelake.streaming.triggers import trigger


# How the path of a landed page names its poll.
POLL_TIME_IN_PATH = r"polled_at=(\d{8}T\d{6}\.\d{6}Z)"
POLL_TIME_FORMAT = "yyyyMMdd'T'HHmmss.SSSSSSX"
RUN_ID_IN_PATH = r"run_id=([^/]+)"


def poll_events(pages: DataFrame, config: LakeConfig, *, by_file_time: bool = False) -> DataFrame:
    """Events of landed pages: a page file is one poll.

    Its path says when that was and its run id, ``.../polled_at=20240101T000000.000000Z/
    run_id=r1/...``; without a run id, the path is digested to one. So a page that
    is copied or read again makes the same events again. A page whose path tells no
    time gives events without one, which the quarantine keeps; ``by_file_time`` takes
    the time its file was written instead.
    """
    # Twice: the name of a folder is escaped, and so is the path as a URI.
    path = F.col("source_file")
    for _escape in range(2):
        path = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    told = F.nullif(F.regexp_extract(path, POLL_TIME_IN_PATH, 1), F.lit(""))
    poll_time = F.try_to_timestamp(told, F.lit(POLL_TIME_FORMAT))
    run_id = F.nullif(F.regexp_extract(path, RUN_ID_IN_PATH, 1), F.lit(""))
    below_lake = F.regexp_extract(path, r"([^/]*=[^/]*/)*[^/]*$", 0)
    if by_file_time:
        poll_time = F.coalesce(poll_time, F.col("landed_at"))
        below_lake = F.concat_ws("|", below_lake, F.unix_micros("landed_at"))
    events = pages_to_events(
        pages,
        poll_time=poll_time,
        run_id=F.coalesce(run_id, F.md5(below_lake)),
        source=config.source,
        vs_currency=config.vs_currency,
    )
    return filter_ids(events, config.coin_ids)


def start_polls(
    pages: DataFrame, config: LakeConfig, records_path: str, *, available_now: bool = False
) -> StreamingQuery:
    """Store the events of a stream of pages as keyed JSON records in files.

    ``quotelake.sinks.publish_stream`` sends the same records to a broker. Each
    micro-batch reports the number it sent as the metric ``sent`` of ``polls``.
    """
    return (
        keyed_json(poll_events(pages, config))
        .observe("polls", F.count(F.lit(1)).alias("sent"))
        .writeStream.format("parquet")
        .option("path", records_path)
        .option("checkpointLocation", config.checkpoint("polls"))
        .trigger(**trigger(config, available_now))
        .start()
    )


def _text(records: DataFrame) -> DataFrame:
    return records.withColumn("value", F.col("value").cast("string"))


def landed_records(records: DataFrame) -> DataFrame:
    """Values of the readable records, one line each, and their topic partition.

    A line break within valid JSON lies between two tokens, so a blank may
    stand for it.
    """
    line = F.regexp_replace("value", r"[\r\n]+", " ").alias("value")
    columns = [line, "partition"] if "partition" in records.columns else [line]
    return _text(records).where(is_json(F.col("value"))).select(*columns)


def rejected_records(records: DataFrame) -> DataFrame:
    """The records ``landed_records`` leaves out: null values, and text that is not JSON."""
    return _text(records).where(~is_json(F.col("value")))


def start_landing(
    records: DataFrame,
    config: LakeConfig,
    *,
    available_now: bool = False,
    records_per_file: int | None = None,
) -> StreamingQuery:
    """Write a stream of topic records to bronze as JSON lines, bad ones left out.

    ``records_per_file`` cuts files at a number of records, such as 50; small
    files cost more to list and open than to read, so there is no cut by default.
    """
    lines = landed_records(records).observe("landing", F.count(F.lit(1)).alias("landed"))
    writer = lines.writeStream.format("text")
    if "partition" in lines.columns:
        writer = writer.partitionBy("partition")
    records_per_file = records_per_file or config.records_per_file
    if records_per_file:
        writer = writer.option("maxRecordsPerFile", records_per_file)
    return (
        writer.option("path", config.bronze)
        .option("checkpointLocation", config.checkpoint("landing"))
        .trigger(**trigger(config, available_now))
        .start()
    )


def start_rejects(
    records: DataFrame, config: LakeConfig, *, available_now: bool = False
) -> StreamingQuery:
    """Keep the records that ``start_landing`` leaves out."""
    return (
        rejected_records(records)
        .observe("rejects", F.count(F.lit(1)).alias("rejected"))
        .writeStream.format("parquet")
        .option("path", config.rejects)
        .option("checkpointLocation", config.checkpoint("rejects"))
        .trigger(**trigger(config, available_now))
        .start()
    )
