"""API objects to quote events, and events to keyed JSON records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.functions import event_json, iso_text, record_key
from quotelake.schemas import BRONZE_SCHEMA

# Event columns that have another name in the API object.
RENAMED = {
    "coin_id": "id",
    "price_usd": "current_price",
    "market_cap_usd": "market_cap",
    "total_volume_usd": "total_volume",
}


def pages_to_events(
    pages: DataFrame,
    *,
    poll_time: Column,
    run_id: Column,
    source: str,
    vs_currency: str,
) -> DataFrame:
    """One quote event per API object, stamped with its poll's time and run id."""
    stamps = {
        "event_time": iso_text(poll_time),
        "ingestion_run_id": run_id,
        "source": F.lit(source),
        "vs_currency": F.lit(vs_currency),
    }
    return pages.select(
        *[
            stamps.get(name, F.col(RENAMED.get(name, name))).alias(name)
            for name in BRONZE_SCHEMA.fieldNames()
        ]
    )


def filter_ids(
    quotes: DataFrame, ids: Sequence[str] | DataFrame | None, *, column: str = "coin_id"
) -> DataFrame:
    """Rows of the given entities; every row when no ids are given.

    A list is looked up in a hash set. Give a long one as a table with a column of
    that name: its join side is broadcast or not by Spark's own size check.
    """
    if isinstance(ids, DataFrame):
        return quotes.join(ids.select(column), column, "left_semi")
    if not ids:
        return quotes
    return quotes.where(F.col(column).isin(list(ids)))


def keyed_json(events: DataFrame) -> DataFrame:
    """Events as ``key`` and ``value`` texts, ready for a topic."""
    return events.select(
        record_key(F.col("coin_id"), F.col("symbol")).alias("key"),
        event_json().alias("value"),
    )


def count_by_run(events: DataFrame) -> DataFrame:
    """Number of events each poll run sent."""
    return events.groupBy("ingestion_run_id").agg(F.count(F.lit(1)).alias("sent"))
