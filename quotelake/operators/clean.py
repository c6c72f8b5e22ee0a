"""Raw events to cleaned quotes, and the records that do not make it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.functions import parse_instant
from quotelake.schemas import BRONZE_SCHEMA, CORRUPT_RECORD, RECORD_TEXT, SILVER_SCHEMA
from quotelake.session import require_utc


def parse_events(events: DataFrame) -> DataFrame:
    """Add both timestamps and the UTC day; unreadable times become null."""
    require_utc(events.sparkSession)
    return events.withColumns(
        {
            "event_time_ts": parse_instant("event_time"),
            "last_updated_ts": parse_instant("last_updated"),
        }
    ).withColumn("dt", F.to_date("event_time_ts"))


def clean_events(events: DataFrame) -> DataFrame:
    """Silver rows: events that name their coin and have a readable time."""
    return (
        parse_events(events)
        .where(F.col("coin_id").isNotNull() & F.col("event_time_ts").isNotNull())
        .select(*SILVER_SCHEMA.fieldNames())
    )


def tag_events(events: DataFrame) -> DataFrame:
    """Add ``status``: why a row is dropped, or whether a kept row lost a field.

    ``clean`` and ``partial`` rows are the ones ``clean_events`` keeps; a
    ``partial`` row had a field of the wrong type, which is null now.
    """
    corrupt = F.col(CORRUPT_RECORD).isNotNull()
    any_field = F.coalesce(*[F.col(c).cast("string") for c in BRONZE_SCHEMA.fieldNames()])
    status = (
        F.when(corrupt & any_field.isNull(), "unreadable")
        .when(F.col("coin_id").isNull(), "no_coin_id")
        .when(F.col("event_time_ts").isNull(), "no_event_time")
        .when(corrupt, "partial")
        .otherwise("clean")
    )
    return parse_events(events).withColumn("status", status)


def quarantined_events(events: DataFrame) -> DataFrame:
    """The records ``clean_events`` drops: reason, text, file and ingestion time.

    The text is that of the record as it was read, with all its fields.
    """
    return (
        tag_events(events)
        .where(F.col("coin_id").isNull() | F.col("event_time_ts").isNull())
        .select(
            F.col("status").alias("reason"),
            F.col(RECORD_TEXT).alias("record"),
            "source_file",
            "ingestion_time",
        )
    )
