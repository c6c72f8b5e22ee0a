"""Parquet tables: append days, replace days, replace a whole table.

Never write a path the DataFrame still reads from: the old files are removed
before the new ones are complete.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter

from quotelake.session import dropped_shuffles, short_splits

# Most rows of a lake are in several tables; Spark's own choice takes half as much again.
COMPRESSION = "zstd"
# A task that sorts a bucket holds its rows, some 250 bytes each, at once.
BUCKET_ROWS = 400_000
LEAST_BUCKETS = 8
# Spark's own limit, unless ``spark.sql.sources.bucketing.maxBuckets`` is raised.
MOST_BUCKETS = 100_000


def cluster_by_day(table: DataFrame) -> DataFrame:
    """Gather each day in few files; adaptive execution splits a large day."""
    return table.hint("rebalance", "dt")


def _save(table: DataFrame, writer: DataFrameWriter, path: str) -> None:
    with dropped_shuffles(table.sparkSession), short_splits(table.sparkSession):
        writer.parquet(path, compression=COMPRESSION)


def append_days(table: DataFrame, path: str, *, cluster: bool = True) -> None:
    """Add rows to a table partitioned by ``dt``."""
    rows = cluster_by_day(table) if cluster else table
    _save(table, rows.write.mode("append").partitionBy("dt"), path)


def replace_days(table: DataFrame, path: str, *, cluster: bool = True) -> None:
    """Replace the days that occur in ``table``; other days stay as they are."""
    rows = cluster_by_day(table) if cluster else table
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    _save(table, writer.partitionBy("dt"), path)


def append_days_for_lookup(
    table: DataFrame, path: str, *, column: str = "coin_id", distinct: int = 100_000, group_bytes: int | None = None
) -> None:
    """Add rows so that a few values of ``column`` are found without reading their days whole.

    Rows of a day lie sorted by the column, and each row group has a Bloom filter for
    about ``distinct`` values: a filter on the column skips row groups by their bounds,
    and those that lie within the bounds but lack the value by the Bloom filter.
    """
    rows = cluster_by_day(table).sortWithinPartitions("dt", column)
    writer = rows.write.mode("append").partitionBy("dt")
    writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", str(distinct))
    # A dictionary would stand in for the filter, until it grows too large and is dropped.
    writer = writer.option(f"parquet.enable.dictionary#{column}", "false")
    if group_bytes:
        writer = writer.option("parquet.block.size", str(group_bytes))
        # Row groups are cut where this many rows are looked at.
        writer = writer.option("parquet.page.size.row.check.min", "10")
    writer.parquet(path)


def save_bucketed(
    table: DataFrame, name: str, path: str, *, buckets: int | None = None, keys: tuple[str, ...] = ("coin_id",)
) -> DataFrame:
    """A table of the session's catalog, in ``buckets`` by the keys and sorted by them.

    Rankings, aggregates and joins by the keys, or by more columns with them, need no
    shuffle: each bucket is one task's. Without a number the rows are counted first, and
    there are as many buckets as hold ``BUCKET_ROWS`` each; rows of one key are in one
    bucket, so this is for keys of like size.
    """
    if buckets is None:
        buckets = min(MOST_BUCKETS, max(LEAST_BUCKETS, -(-table.count() // BUCKET_ROWS)))
    rows = table.repartition(buckets, *keys)
    rows.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).mode("overwrite").saveAsTable(name)
    return table.sparkSession.table(name)


def replace_folders(table: DataFrame, path: str, *below: str, all_of_it: bool = False) -> None:
    """Replace the folders by day and ``below`` that occur in ``table``; others stay,
    unless it is ``all_of_it``."""
    rows = table.hint("rebalance", "dt", *below)
    mode = "static" if all_of_it else "dynamic"
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", mode)
    _save(table, writer.partitionBy("dt", *below), path)


def replace_table(
    table: DataFrame, path: str, *, by_day: bool = False, cluster: bool = True
) -> None:
    """Replace all rows of a table, which ``by_day`` partitions by ``dt``."""
    rows = cluster_by_day(table) if by_day and cluster else table
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if by_day:
        writer = writer.partitionBy("dt")
    _save(table, writer, path)
