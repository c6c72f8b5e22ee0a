"""JSON texts to event rows, the same for lines of files and records of a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.schemas import CORRUPT_RECORD, RECORD_TEXT, with_corrupt_record

_PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_RECORD}


def event_rows(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per object of the JSON texts in ``value``, and the other columns.

    A text that is no JSON becomes a row of nulls, a field of the wrong type
    becomes null; both keep the text in the corrupt-record column. An array gives
    its objects, whose wrong fields become null without that mark. Null and blank
    texts are no records. Every row has its whole text as ``RECORD_TEXT``.

    A filter on a parsed field would move below a plain projection and parse
    each text once more; it does not move below ``inline``.
    """
    text = F.col("value").cast("string")
    carried = [c for c in lines.columns if c != "value"]
    one = F.from_json(text, with_corrupt_record(schema), _PERMISSIVE)
    many = F.from_json(text, T.ArrayType(schema), {"mode": "PERMISSIVE"})
    unmarked = F.transform(
        many,
        lambda item: F.struct(
            *[item[name].alias(name) for name in schema.fieldNames()],
            F.lit(None).cast("string").alias(CORRUPT_RECORD),
        ),
    )
    is_array = F.ltrim(text).startswith("[")
    objects = F.when(is_array & many.isNotNull(), unmarked).otherwise(F.array(one))
    rows = lines.where(F.trim(text) != "").select(*carried, text.alias(RECORD_TEXT), F.inline(objects))
    return rows.select(*schema.fieldNames(), CORRUPT_RECORD, *carried, RECORD_TEXT)
