"""Keys and JSON values of quote events."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quotelake.schemas import BRONZE_SCHEMA

# Fixed value: key of an event that names neither its coin nor its symbol.
UNKNOWN_KEY = "unknown"


def record_key(coin_id: Column, symbol: Column) -> Column:
    """Coin id, else symbol, else a fixed text; empty text counts as missing."""
    blank = F.lit("")
    return F.coalesce(F.nullif(coin_id, blank), F.nullif(symbol, blank), F.lit(UNKNOWN_KEY))


def event_json() -> Column:
    """The event columns of a row as one JSON object that spells out nulls."""
    return F.to_json(F.struct(*BRONZE_SCHEMA.fieldNames()), {"ignoreNullFields": "false"})


def is_json(text: Column) -> Column:
    """True for any valid JSON text, false for other text, and for null.

    The variant parser refuses an object that repeats a key. That is valid JSON
    and readable, so what it refuses is parsed once more, as a strict object.
    """
    strict = F.from_json(
        text,
        "_other string",
        {
            "columnNameOfCorruptRecord": "_other",
            "allowSingleQuotes": "false",
            "allowNonNumericNumbers": "false",
        },
    )
    is_object = strict.isNotNull() & strict.getField("_other").isNull()
    return F.try_parse_json(text).isNotNull() | is_object
