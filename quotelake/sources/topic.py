"""The quote topic: keyed JSON records. Needs the Kafka connector on the class path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.schemas import BRONZE_SCHEMA
from quotelake.sources.lines import event_rows


def topic_options(
    servers: str,
    topic: str,
    *,
    starting: str | None = None,
    records_per_batch: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of a read from the topic; those not given are left to the connector."""
    if not servers or not topic:
        raise ValueError("a topic needs its servers and its name")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "maxOffsetsPerTrigger": records_per_batch,
        "minPartitions": min_partitions,
    }
    return {name: str(value) for name, value in options.items() if value is not None}


def read_topic(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """All records the topic holds now."""
    return spark.read.format("kafka").options(**topic_options(servers, topic)).load()


def stream_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    *,
    starting: str = "earliest",
    records_per_batch: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """The topic as a stream.

    ``min_partitions`` splits a topic partition that holds most records into
    several offset ranges, so that it is not read by one task.
    """
    options = topic_options(
        servers,
        topic,
        starting=starting,
        records_per_batch=records_per_batch,
        min_partitions=min_partitions,
    )
    return spark.readStream.format("kafka").options(**options).load()


def decode_events(records: DataFrame, *, ingestion_time: Column | None = None) -> DataFrame:
    """Topic records to the rows ``read_events`` gives for the same JSON texts."""
    lines = records.select(
        "value", F.concat_ws("/", "topic", "partition", "offset").alias("source_file")
    )
    now = F.current_timestamp() if ingestion_time is None else ingestion_time
    return event_rows(lines, BRONZE_SCHEMA).withColumn("ingestion_time", now)
