"""A table of what every poll and batch did, and why one failed.

A listener takes what Spark reports of the queries of a session: rows read, the counts
that the queries observe (``sent``, ``landed``, ``rejected``, ``kept``, ``quarantined``),
and the error a query ended with. Rows are appended in small numbers; a failure at once.
"""

from __future__ import annotations

import threading
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from quotelake.config import LakeConfig

RUN_LOG_SCHEMA = (
    "stream string, query_id string, run_id string, batch_id long, reported_at timestamp, "
    "input_rows long, counts map<string, long>, failure string"
)


class RunLog(StreamingQueryListener):
    """Attached to a session by ``with RunLog(spark, config) as log``.

    ``watch`` names a query in the log; without it the name of its counts stands there.
    Of a driver that is lost, the last ``rows_per_file`` reports may be missing.
    """

    def __init__(self, spark: SparkSession, config: LakeConfig, *, rows_per_file: int = 10):
        self.spark, self.config, self.rows_per_file = spark, config, rows_per_file
        self.names: dict[str, str] = {}
        self.rows: list[tuple] = []
        self.last_batch: dict[str, int] = {}
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def __enter__(self) -> RunLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error: object) -> None:
        self.spark.streams.removeListener(self)
        self.write()

    def watch(self, query: StreamingQuery, stream: str) -> StreamingQuery:
        with self.changed:
            self.names[str(query.id)] = stream
        return query

    def finish(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Wait for a query's end and for its last report; its error is raised as ever."""
        run = str(query.runId)
        try:
            query.awaitTermination()
        finally:
            with self.changed:
                self.changed.wait_for(lambda: run in self.ended, seconds)
            self.write()

    def write(self) -> None:
        """Append the reports so far to the table."""
        with self.changed:
            rows, self.rows = self.rows, []
            named = [(self.names.get(row[1], row[0]), *row[1:]) for row in rows]
        if named:
            table = self.spark.createDataFrame(named, RUN_LOG_SCHEMA)
            table.coalesce(1).write.mode("append").parquet(self.config.run_log)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        observed = {name: row.asDict() for name, row in progress.observedMetrics.items()}
        counts = {name: many for each in observed.values() for name, many in each.items()}
        # A trigger that found nothing reports as well.
        if not progress.numInputRows and not any(counts.values()):
            return
        query, stream = str(progress.id), next(iter(observed), progress.name)
        at = datetime.fromisoformat(progress.timestamp)
        row = (stream, query, str(progress.runId), progress.batchId, at, progress.numInputRows, counts, None)
        with self.changed:
            self.names.setdefault(query, stream or query)
            self.last_batch[query] = progress.batchId
            self.rows.append(row)
            full = len(self.rows) >= self.rows_per_file
        if full:
            self.write()

    def onQueryTerminated(self, event) -> None:
        query, run = str(event.id), str(event.runId)
        with self.changed:
            if event.exception is not None:
                # The batch after the last that was done, if there was one in this session.
                failed = self.last_batch.get(query, -1) + 1
                at = datetime.now().astimezone()
                self.rows.append((query, query, run, failed, at, None, {}, event.exception))
        if event.exception is not None:
            self.write()
        with self.changed:
            self.ended.add(run)
            self.changed.notify_all()


def read_run_log(spark: SparkSession, config: LakeConfig) -> DataFrame:
    return spark.read.schema(RUN_LOG_SCHEMA).parquet(config.run_log)


def run_totals(log: DataFrame) -> DataFrame:
    """``stream, count_name, records`` over all batches, and failures as a count of their own."""
    done = log.where("failure is null").select("stream", F.explode("counts").alias("count_name", "records"))
    failed = log.select("stream", F.lit("failures").alias("count_name"), F.col("failure").isNotNull().cast("long").alias("records"))
    return done.union(failed).groupBy("stream", "count_name").agg(F.sum("records").alias("records"))
