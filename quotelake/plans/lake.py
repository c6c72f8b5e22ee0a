"""The whole chain: landed pages to gold."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession

from quotelake.config import LakeConfig
from quotelake.plans.gold import build_gold
from quotelake.plans.silver import build_history, build_silver
from quotelake.plans.update import update_serving
from quotelake.sources import stream_pages
from quotelake.streaming.ingest import start_landing, start_polls, start_rejects


def build_lake(
    spark: SparkSession,
    config: LakeConfig,
    *,
    start: str = "pages",
    as_of: Column | None = None,
    quarantine: bool = True,
    full: bool = False,
) -> None:
    """Run every stage from ``start`` on over what is new.

    ``start`` is ``pages``, ``records`` or ``bronze``. Files of records stand
    in for the topic; a lake whose topic is landed by a continuous query
    starts at ``bronze``. Records that land or history leave out are kept, one
    more pass over the new ones each, unless ``quarantine`` is off. Only days that
    new rows touch are served anew; ``full`` makes the latest rows of those and all
    of gold. Use one or the other on a lake: each knows what it took in itself.
    """
    if start not in ("pages", "records", "bronze"):
        raise ValueError(f"start is 'pages', 'records' or 'bronze', not {start!r}")
    if start == "pages":
        pages = stream_pages(spark, config.pages, files_per_batch=config.files_per_batch)
        start_polls(pages, config, config.records, available_now=True).awaitTermination()
    if start != "bronze":
        records = spark.readStream.schema("key string, value string").parquet(config.records)
        start_landing(records, config, available_now=True).awaitTermination()
        if quarantine:
            start_rejects(records, config, available_now=True).awaitTermination()
    if full:
        build_silver(spark, config, quarantine=quarantine)
        build_gold(spark, config, as_of=as_of)
    else:
        build_history(spark, config, quarantine=quarantine)
        update_serving(spark, config, as_of=as_of)
