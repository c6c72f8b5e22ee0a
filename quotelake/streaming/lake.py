"""The whole chain as continuous queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quotelake.config import LakeConfig
from quotelake.sources import stream_events
from quotelake.streaming.gold import start_serving
from quotelake.streaming.ingest import start_landing, start_rejects
from quotelake.streaming.silver import start_history, start_quarantine


def start_lake(
    spark: SparkSession,
    config: LakeConfig,
    records: DataFrame,
    *,
    serve_every_seconds: int | None = None,
    quarantine: bool = True,
) -> list[StreamingQuery]:
    """Start landing, history and serving over a stream of topic records.

    Records that landing or history leave out are kept, unless ``quarantine`` is
    off; each of these two queries reads its input once more.
    """
    events = stream_events(
        spark,
        config.bronze,
        files_per_batch=config.files_per_batch,
        integral_amounts=config.integral_amounts,
    )
    queries = [
        start_landing(records, config),
        start_history(events, config),
        start_serving(spark, config, every_seconds=serve_every_seconds),
    ]
    if quarantine:
        queries += [start_rejects(records, config), start_quarantine(events, config)]
    return queries
