"""What the text operators share: reading, settling a table, graph components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.session import scratch_path

T = TypeVar("T")

# Arrow batches hold whole texts, some of them very long: few rows a batch bound
# what a Python worker holds at once.
ROWS_PER_BATCH = 512


def once(make: Callable[[], T]) -> Callable[[], T]:
    """``make`` run when first asked for, and its value from then on.

    Unlike the caches of the standard library this is shipped by value.
    """
    kept: list[T] = []

    def get() -> T:
        if not kept:
            kept.append(make())
        return kept[0]

    return get


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = ROWS_PER_BATCH) -> None:
    """Bound the rows of an Arrow batch for operators over whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


@contextmanager
def batches_of(spark: SparkSession, rows: int = ROWS_PER_BATCH) -> Iterator[None]:
    """Jobs that run inside have Arrow batches of so many rows; the session's own size comes back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def settle(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: cuts lineage, survives executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Return what was freed to the machine: a worker stays for other tasks."""
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()


def in_fold(key: Column, modulus: int, remainder: int) -> Column:
    """crc32 of an id as text, modulo; a null id counts as empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus == remainder


def components(edges: DataFrame, label: str) -> DataFrame:
    """``node, root`` for all nodes of the undirected edges ``a, b`` (longs).

    ``root`` is the smallest node reachable. Large-star and small-star rounds:
    each re-hangs neighbours on the smallest one seen, so a round's output is no
    larger than its input. Minima combine before the shuffle, and the join back
    may be split by adaptive execution, so one huge star needs no single task.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    pairs = edges.where("a <> b").select(low.alias("a"), high.alias("b")).distinct()
    pairs = settle(pairs, f"{label}-edges")
    while True:
        both = pairs.union(pairs.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        # Large star: every larger neighbour hangs on the smallest known.
        large = (
            both.where("b > a")
            .join(least, F.col("a") == F.col("u"))
            .select(F.col("m").alias("a"), "b")
        ).distinct()
        # Small star: every smaller neighbour hangs on the smallest of them.
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least.withColumnRenamed("b", "u"), F.col("b") == F.col("u"))
        fixed = small.select(F.col("m").alias("a"), F.col("a").alias("b")).where("a <> b")
        fixed = fixed.union(least.select(F.col("m").alias("a"), "b")).distinct()
        fixed = settle(fixed, f"{label}-stars")
        if _digest(fixed) == _digest(pairs):
            break
        pairs = fixed
    roots = fixed.select(F.col("b").alias("node"), F.col("a").alias("root"))
    tops = fixed.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    return roots.union(tops)


def _digest(pairs: DataFrame) -> tuple:
    """Equal for equal sets of pairs; three numbers reach the driver."""
    mixed = F.xxhash64("a", "b")
    return tuple(
        pairs.agg(
            F.count("*"),
            F.sum(mixed.bitwiseAND(F.lit(0xFFFFFFFF))),
            F.bit_xor(mixed),
        ).first()
    )
