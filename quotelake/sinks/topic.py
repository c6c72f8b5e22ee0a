"""The quote topic as a sink. Needs the Kafka connector on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from quotelake.operators import keyed_json

# Every replica acknowledges, three retries, ten milliseconds to batch.
PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.retries": "3",
    "kafka.linger.ms": "10",
}


def producer_options(servers: str, topic: str) -> dict[str, str]:
    """Options of a write to the topic."""
    if not servers or not topic:
        raise ValueError("a topic needs its servers and its name")
    return {"kafka.bootstrap.servers": servers, "topic": topic, **PRODUCER_OPTIONS}


def publish_topic(events: DataFrame, servers: str, topic: str) -> None:
    """Send events as keyed JSON records."""
    keyed_json(events).write.format("kafka").options(**producer_options(servers, topic)).save()


def publish_stream(
    events: DataFrame, servers: str, topic: str, checkpoint: str, *, poll_seconds: int = 60
) -> StreamingQuery:
    """Send a stream of events, one micro-batch per poll interval."""
    return (
        keyed_json(events)
        .writeStream.format("kafka")
        .options(**producer_options(servers, topic))
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=f"{poll_seconds} seconds")
        .start()
    )
