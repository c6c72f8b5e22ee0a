"""Column lists, types and required columns of every table in the lake.

The names, their order and their types are fixed values: tables written by
earlier deployments of the same pipeline have to stay readable and comparable.
Where those hold amounts as longs, ``read_table`` and ``stream_table`` cast them.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "date": T.DateType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
}


def _table(columns: str) -> T.StructType:
    """Schema from lines of name and type; unlike DDL it needs no session."""
    pairs = [line.split() for line in columns.strip().splitlines()]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# One object of a quote page, as the market API names its fields.
PAGE_SCHEMA = _table(
    """
    id string
    symbol string
    name string
    current_price double
    market_cap double
    total_volume double
    price_change_percentage_24h double
    market_cap_rank int
    last_updated string
    """
)

# One raw quote event. The two amounts are doubles, so that an
# amount written as 10.5 or 1.0e12 survives the parse.
BRONZE_SCHEMA = _table(
    """
    event_time string
    ingestion_run_id string
    source string
    vs_currency string
    coin_id string
    symbol string
    name string
    price_usd double
    market_cap_usd double
    total_volume_usd double
    price_change_percentage_24h double
    market_cap_rank int
    last_updated string
    """
)

# Column the permissive JSON parser fills with the raw text of a bad record.
CORRUPT_RECORD = "_corrupt_record"

# Column of the text that an event was read from.
RECORD_TEXT = "_record_text"

# Cleaned quotes, history and latest alike.
SILVER_SCHEMA = _table(
    """
    dt date
    event_time_ts timestamp
    last_updated_ts timestamp
    ingestion_time timestamp
    ingestion_run_id string
    source string
    vs_currency string
    coin_id string
    symbol string
    name string
    market_cap_rank int
    price_usd double
    price_change_percentage_24h double
    market_cap_usd double
    total_volume_usd double
    source_file string
    """
)

# The silver columns whose type the gold contract does not touch.
UNCAST_COLUMNS = ("ingestion_time", "ingestion_run_id", "source", "source_file")

# Columns that have to exist and hold no null before publishing.
REQUIRED_COLUMNS = (
    "dt",
    "coin_id",
    "symbol",
    "name",
    "event_time_ts",
    "price_usd",
    "market_cap_usd",
    "total_volume_usd",
    "vs_currency",
)

# The published quote fact table.
GOLD_QUOTES_SCHEMA = _table(
    """
    dt date
    event_time_ts timestamp
    last_updated_ts timestamp
    coin_id string
    symbol string
    name string
    vs_currency string
    market_cap_rank int
    price_usd double
    price_change_percentage_24h double
    market_cap_usd double
    total_volume_usd double
    source string
    """
)

# The published daily metrics; the first five columns are the keys.
GOLD_DAILY_SCHEMA = _table(
    """
    dt date
    coin_id string
    symbol string
    name string
    vs_currency string
    avg_price_usd double
    min_price_usd double
    max_price_usd double
    max_market_cap_usd double
    max_total_volume_usd double
    last_price_usd double
    """
)
DAILY_KEYS = ("dt", "coin_id", "symbol", "name", "vs_currency")


def bronze_schema(*, integral_amounts: bool = False) -> T.StructType:
    """Schema of the raw events.

    With ``integral_amounts`` the two amounts are read as longs, and an amount
    with a fraction becomes null, as older deployments did.
    """
    if not integral_amounts:
        return BRONZE_SCHEMA
    amounts = {"market_cap_usd", "total_volume_usd"}
    return T.StructType(
        [
            T.StructField(f.name, T.LongType()) if f.name in amounts else f
            for f in BRONZE_SCHEMA.fields
        ]
    )


def with_corrupt_record(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT_RECORD, T.StringType())])
