"""The current snapshot as the state of a stream over the history."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quotelake.config import LakeConfig
from quotelake.operators import enforce_contract
from quotelake.operators.latest import ranking_order_names
from quotelake.schemas import SILVER_SCHEMA
from quotelake.sinks.tables import replace_table
from quotelake.sources import stream_table
from quotelake.streaming.triggers import trigger

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
# On disk in the executors, with changes kept in the checkpoint: no heap holds all coins.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def snapshot_rows(quotes: DataFrame) -> DataFrame:
    """The last quote of each coin, as ``current_snapshot`` ranks them, by aggregation.

    A structure is as great as its first field that differs, and nulls are least: the
    greatest one is the row that a descending ranking has first. Tasks combine before
    the shuffle, so a coin with a third of all rows is one row of each.
    """
    ordered = ranking_order_names(SILVER_SCHEMA.fieldNames(), ("coin_id",), ("event_time_ts", "last_updated_ts"))
    last = quotes.groupBy("coin_id").agg(F.max(F.struct(*ordered)).alias("last"))
    return last.select("coin_id", "last.*").select(*SILVER_SCHEMA.fieldNames())


def _staged_batch(spark: SparkSession, path: str) -> int | None:
    try:
        row = spark.read.parquet(path).select("batch_id").first()
    except AnalysisException:
        return None
    return None if row is None else row[0]


def publish_snapshot(changed: DataFrame, batch_id: int, config: LakeConfig) -> None:
    """Replace the rows of the coins that changed; other rows are copied.

    The whole table is staged under the batch's number first: a batch that was cut off
    while it replaced the snapshot finds it there. The first batch has every coin. A
    batch's rows are asked for once, as that is what moves the state on.
    """
    spark = changed.sparkSession
    replace_table(changed, f"{config.snapshot_staging}-changes")
    if batch_id == 0 or _staged_batch(spark, config.snapshot_staging) != batch_id:
        changed = merged = spark.read.schema(SILVER_SCHEMA).parquet(f"{config.snapshot_staging}-changes")
        if batch_id:
            old = spark.read.schema(SILVER_SCHEMA).parquet(config.snapshot)
            merged = changed.unionByName(old.join(changed.select("coin_id"), "coin_id", "left_anti"))
        replace_table(merged.withColumn("batch_id", F.lit(batch_id)), config.snapshot_staging)
    staged = spark.read.schema(SILVER_SCHEMA).parquet(config.snapshot_staging)
    replace_table(staged, config.snapshot)


def start_snapshot(
    spark: SparkSession,
    config: LakeConfig,
    *,
    available_now: bool = False,
    every_seconds: int | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Keep the snapshot from the rows of new history alone.

    The state has one row a coin, so no batch reads history or latest rows again; late
    rows of any age are compared with it, and there is no watermark that drops them.
    The snapshot keeps the day, which a run over the latest rows leaves out.
    """
    new_rows = stream_table(spark, config.history, SILVER_SCHEMA, files_per_batch=files_per_batch)

    def publish(changed: DataFrame, batch_id: int) -> None:
        publish_snapshot(changed, batch_id, config)

    before = spark.conf.get(PROVIDER, None)
    # A query takes the settings of its session as they are when it starts.
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return (
            snapshot_rows(enforce_contract(new_rows))
            .writeStream.outputMode("update")
            .foreachBatch(publish)
            .option("checkpointLocation", config.checkpoint("snapshot"))
            .trigger(**trigger(config, available_now, every_seconds or config.serve_seconds))
            .start()
        )
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)
