"""The given tables seen as quotes, raw events and landed pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.functions import event_json, iso_text, record_key
from quotelake.schemas import PAGE_SCHEMA, SILVER_SCHEMA
from quotelake.session import use_settings

POLL_PAGE = 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_settings(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def event_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as cleaned quotes; whole hours as event times make duplicates."""
    ts = F.col("ts").cast("timestamp")
    hour = F.date_trunc("hour", ts)
    columns = {
        "dt": F.to_date(ts),
        "event_time_ts": hour,
        "last_updated_ts": ts,
        "ingestion_time": hour,
        "ingestion_run_id": F.concat(F.lit("poll-"), iso_text(hour)),
        "source": F.lit("events"),
        "vs_currency": F.lit("usd"),
        "coin_id": F.col("event_type"),
        "symbol": F.substring("event_type", 1, 3),
        "name": F.upper("event_type"),
        "market_cap_rank": (F.col("event_id") % 50 + 1).cast("int"),
        "price_usd": F.greatest("value", F.lit(0.01)),
        "price_change_percentage_24h": (F.col("event_id") % 21 - 10).cast("double"),
        "market_cap_usd": (F.col("event_id") % 1000).cast("double"),
        "total_volume_usd": (F.col("event_id") % 777).cast("double"),
        "source_file": F.lit("events"),
    }
    return _silver(table(spark, sf_dir, "events"), columns, "event_id")


def line_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as cleaned quotes: parts are the coins, ship months the days."""
    shipped = F.col("l_shipdate").cast("timestamp")
    part = F.col("l_partkey").cast("string")
    columns = {
        "dt": F.to_date(F.date_trunc("month", shipped)),
        "event_time_ts": shipped,
        "last_updated_ts": F.lit(None).cast("timestamp"),
        "ingestion_time": shipped,
        "ingestion_run_id": F.concat_ws(
            "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
        ),
        "source": F.lit("lineitem"),
        "vs_currency": F.lit("usd"),
        "coin_id": part,
        "symbol": F.concat(F.lit("p"), part),
        "name": F.concat(F.lit("part "), part),
        "market_cap_rank": F.col("l_linenumber"),
        "price_usd": F.col("l_extendedprice"),
        "price_change_percentage_24h": F.col("l_discount"),
        "market_cap_usd": F.col("l_quantity"),
        "total_volume_usd": F.col("l_tax"),
        "source_file": F.lit("lineitem"),
    }
    return _silver(table(spark, sf_dir, "lineitem"), columns)


def _silver(rows: DataFrame, columns: dict[str, Column], *more: str) -> DataFrame:
    assert list(columns) == SILVER_SCHEMA.fieldNames()
    return rows.select(*[c.alias(name) for name, c in columns.items()], *more)


def raw_events(spark: SparkSession, sf_dir: str, *, faulty: bool) -> DataFrame:
    """``events`` as raw quote events with times as text.

    With ``faulty``, every 89th event has no coin and every 83rd no readable time.
    """
    quotes = event_quotes(spark, sf_dir)
    event_time = iso_text(F.col("event_time_ts"))
    coin_id = F.col("coin_id")
    if faulty:
        event_time = F.when(F.col("event_id") % 83 == 0, "no time").otherwise(event_time)
        coin_id = F.when(F.col("event_id") % 89 != 0, coin_id)
    return quotes.withColumns(
        {
            "event_time": event_time,
            "coin_id": coin_id,
            "last_updated": iso_text(F.col("last_updated_ts")),
        }
    )


def topic_records(
    spark: SparkSession, sf_dir: str, *, faulty: bool, partial: bool = False
) -> DataFrame:
    """``events`` as topic records.

    With ``faulty``, every 97th value is not JSON; with ``partial``, every 71st
    price is a text.
    """
    events = raw_events(spark, sf_dir, faulty=faulty)
    records = events.select(
        record_key(F.col("coin_id"), F.col("symbol")).alias("key"),
        event_json().alias("value"),
        "event_id",
        F.lit("quotes").alias("topic"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )
    if partial:
        text_price = F.regexp_replace("value", r'"price_usd":[^,]*', '"price_usd":"n/a"')
        records = records.withColumn(
            "value", F.when(F.col("event_id") % 71 == 0, text_price).otherwise(F.col("value"))
        )
    if faulty:
        broken = F.concat(F.lit("not json "), F.col("event_id").cast("string"))
        records = records.withColumn(
            "value", F.when(F.col("event_id") % 97 == 0, broken).otherwise(F.col("value"))
        )
    return records


def drifting_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event records with their ``day``, in which fields come, go and change their kind.

    From the 10th a note is there, from the 16th prices are texts, from the 20th there is
    no symbol; every 7th rank of the 12th is a text, and on the 5th no volume is known.
    """
    day = F.dayofmonth("dt")
    fields = {
        "id": F.col("coin_id"),
        "symbol": F.when(day < 20, F.col("symbol")),
        "price": F.when(day < 16, F.col("market_cap_usd").cast("long").cast("string")),
        "price_text": F.when(day >= 16, F.concat(F.lit("about "), F.col("market_cap_usd").cast("long"))),
        "rank": F.when((day != 12) | (F.col("event_id") % 7 != 0), F.col("market_cap_rank").cast("string")),
        "volume": F.when(day != 5, (F.col("event_id") % 777).cast("string")),
    }
    rows = event_quotes(spark, sf_dir).withColumns(fields)
    shown = [
        F.concat(F.lit('"id":"'), "id", F.lit('"')),
        F.concat(F.lit('"symbol":"'), "symbol", F.lit('"')),
        F.concat(F.lit('"price":'), F.coalesce("price", F.concat(F.lit('"'), "price_text", F.lit('"')))),
        F.concat(F.lit('"rank":'), F.coalesce("rank", F.lit('"none"'))),
        F.concat(F.lit('"volume":'), F.coalesce("volume", F.lit("null"))),
        F.when(day >= 10, F.lit('"note":{"seen":true}')),
    ]
    return rows.select(
        F.col("dt").alias("day"),
        F.when(F.col("event_id") % 97 == 0, "not json").otherwise(F.concat(F.lit("{"), F.concat_ws(",", *shown), F.lit("}"))).alias("value"),
    )


def api_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as the objects of API pages, with their poll's time and run id."""
    quotes = event_quotes(spark, sf_dir)
    columns = {
        "id": F.col("coin_id"),
        "current_price": F.col("price_usd"),
        "market_cap": F.col("market_cap_usd"),
        "total_volume": F.col("total_volume_usd"),
        "last_updated": iso_text(F.col("last_updated_ts")),
    }
    return quotes.select(
        *[columns.get(name, F.col(name)).alias(name) for name in PAGE_SCHEMA.fieldNames()],
        "event_time_ts",
        "ingestion_run_id",
        "event_id",
    )


def write_pages(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Write the objects as JSON arrays of at most fifty, one page per line."""
    page = F.floor(F.col("event_id") / POLL_PAGE)
    item = F.struct(*PAGE_SCHEMA.fieldNames())
    (
        api_objects(spark, sf_dir)
        .groupBy(page.alias("page"))
        .agg(F.to_json(F.collect_list(item)).alias("value"))
        .select("value")
        .write.text(path)
    )


def write_polls(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Write one page a day, in folders that name the poll's time and run."""
    day = F.date_trunc("day", F.col("event_time_ts"))
    item = F.struct(*PAGE_SCHEMA.fieldNames())
    (
        api_objects(spark, sf_dir)
        .groupBy(
            F.date_format(day, "yyyyMMdd'T'HHmmss.SSSSSS'Z'").alias("polled_at"),
            F.date_format(day, "'run of' yyyy-MM-dd HH:mm+0").alias("run_id"),
        )
        .agg(F.to_json(F.collect_list(item)).alias("value"))
        .write.partitionBy("polled_at", "run_id")
        .text(path)
    )


def write_lines(records: DataFrame, path: str) -> None:
    """Write record values as bronze lines, in folders by topic partition."""
    records.select("value", "partition").write.mode("append").partitionBy("partition").text(path)


def comparable(rows: DataFrame) -> DataFrame:
    """Instants as zone-free timestamps, which is how SQL engines print them alike."""
    return rows.select(
        *[
            F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(name)
            for name, kind in rows.dtypes
        ]
    )
