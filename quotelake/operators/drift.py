"""Which fields the raw records have, of what kind, and how that changes by day.

Records are read as VARIANT, so fields that no schema names are seen, too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Kinds of values, and the start of the type names that Spark gives such variants.
KINDS = {
    "number": "BIGINT|DECIMAL|DOUBLE|FLOAT",
    "text": "STRING",
    "flag": "BOOLEAN",
    "list": "ARRAY",
    "object": "OBJECT",
    "null": "VOID",
}


def _kind(value: Column) -> Column:
    shown = F.schema_of_variant(value)
    kind = F.lit("other")
    for name, types in KINDS.items():
        kind = F.when(shown.rlike(f"^({types})"), name).otherwise(kind)
    return kind


def record_fields(records: DataFrame, text: str, day: str) -> DataFrame:
    """``day, field, kind, records, nulls`` of the JSON objects in column ``text``.

    The kinds of a field's values join upwards: ``null`` below any other kind, and
    ``mixed`` above two that differ. Text that is no JSON object has no fields. One
    pass; counts by kind combine before the shuffle.
    """
    spark = records.sparkSession
    parsed = records.select(F.col(day).alias("day"), F.try_parse_json(F.col(text).cast("string")).alias("_record"))
    # Fields of objects only: items of a list have no key.
    fields = parsed.lateralJoin(spark.tvf.variant_explode(F.col("_record").outer())).where("key is not null")
    counts = fields.groupBy("day", F.col("key").alias("field"), _kind(F.col("value")).alias("kind")).agg(
        F.count("*").alias("records")
    )
    is_null = F.col("kind") == "null"
    kinds = F.count_if(~is_null)
    joined = F.when(kinds == 0, "null").when(kinds == 1, F.max(F.when(~is_null, F.col("kind")))).otherwise("mixed")
    nulls = F.coalesce(F.sum(F.when(is_null, F.col("records"))), F.lit(0))
    return counts.groupBy("day", "field").agg(
        joined.alias("kind"), F.sum("records").alias("records"), nulls.alias("nulls")
    )


def schema_drift(fields: DataFrame) -> DataFrame:
    """``day, field, change, old_kind, new_kind``: what differs from the day before.

    ``fields`` is of ``record_fields``; the day before is the last one with any field,
    so a day without records changes nothing. The first day is none. A field is ``new``,
    ``lost``, or ``retyped`` if its kind is another and neither is only nulls.
    """
    fields = fields.where(F.col("day").isNotNull())
    # One row a day: the only rows that are ordered in one task.
    days = fields.select("day").distinct()
    following = days.select("day", F.lead("day").over(W.orderBy("day")).alias("next"))
    old = fields.join(following, "day").where("next is not null")
    old = old.select(F.col("next").alias("day"), "field", F.col("kind").alias("old_kind"))
    first = days.agg(F.min("day").alias("_first"))
    new = fields.join(F.broadcast(first), F.col("day") > F.col("_first"))
    new = new.select("day", "field", F.col("kind").alias("new_kind"))
    both = old.join(new, ["day", "field"], "full")
    change = (
        F.when(F.col("old_kind").isNull(), "new")
        .when(F.col("new_kind").isNull(), "lost")
        .when((F.col("old_kind") != F.col("new_kind")) & (F.col("old_kind") != "null") & (F.col("new_kind") != "null"), "retyped")
    )
    return both.withColumn("change", change).where("change is not null").select("day", "field", "change", "old_kind", "new_kind")
