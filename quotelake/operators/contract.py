"""The column contract of the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.operators.quality import QualityError, missing_columns
from quotelake.schemas import SILVER_SCHEMA, UNCAST_COLUMNS


def enforce_contract(quotes: DataFrame) -> DataFrame:
    """Contract columns in contract order and type; unknown columns are dropped.

    A value that does not fit its type becomes null. A missing required column
    is reported before any cast; lineage columns may be absent.
    """
    missing = missing_columns(quotes)
    if missing:
        raise QualityError([f"missing_columns:{missing}"])
    present = set(quotes.columns)
    columns = []
    for field in SILVER_SCHEMA.fields:
        if field.name not in UNCAST_COLUMNS:
            columns.append(F.col(field.name).try_cast(field.dataType).alias(field.name))
        elif field.name in present:
            columns.append(F.col(field.name))
    return quotes.select(*columns)
