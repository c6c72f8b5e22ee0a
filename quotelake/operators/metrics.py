"""Daily metrics per coin."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.schemas import DAILY_KEYS, GOLD_DAILY_SCHEMA


def daily_metrics(quotes: DataFrame, *, unique_times: bool = False) -> DataFrame:
    """Average, least, greatest and last price, and greatest amounts, per day.

    The last price is the one at the greatest event time, and the greater one
    if several share that time. ``unique_times`` says that none do, as after
    ``dedup_quotes``: the whole aggregate then hashes instead of sorting.
    """
    if unique_times:
        last_price = F.max_by("price_usd", "event_time_ts")
    else:
        last_price = F.max(F.struct("event_time_ts", "price_usd")).getField("price_usd")
    return (
        quotes.groupBy(*DAILY_KEYS)
        .agg(
            F.avg("price_usd").alias("avg_price_usd"),
            F.min("price_usd").alias("min_price_usd"),
            F.max("price_usd").alias("max_price_usd"),
            F.max("market_cap_usd").alias("max_market_cap_usd"),
            F.max("total_volume_usd").alias("max_total_volume_usd"),
            last_price.alias("last_price_usd"),
        )
        .select(*GOLD_DAILY_SCHEMA.fieldNames())
    )
