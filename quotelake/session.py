"""Session settings the operators rely on, and a shared scratch folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from weakref import WeakKeyDictionary

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

# dt is the UTC day of the event time, so the session zone has to be UTC.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Lets a rebalanced write split a hot day over several tasks.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Lets a page of any depth be cut before the shuffle, in each group.
    "spark.sql.optimizer.windowGroupLimitThreshold": "2147483647",
}

# What a task of a write reads: some 1.3 million quotes, which it holds at 300 bytes each.
SPLIT_BYTES = 16 * 1024 * 1024


def build_session(app_name: str, **settings: str) -> SparkSession:
    """Session with the settings above; ``settings`` use ``__`` for the dots."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in SESSION_SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def use_settings(spark: SparkSession) -> SparkSession:
    """Give a session made elsewhere the settings the operators rely on."""
    for name, value in SESSION_SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def require_utc(spark: SparkSession) -> None:
    """Refuse a session in whose zone days and texts without offset mean others."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"set spark.sql.session.timeZone to UTC, not {zone}")


def _bytes(size: str) -> int:
    """A size as Spark's settings have it: ``128MB``, ``64m``, ``1000``."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([a-z]*)\s*", size.lower()).groups()
    return int(number) << 10 * "bkmgtp".index(unit[:1] or "b")


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def shuffle_partitions(spark: SparkSession, count: int | None) -> Iterator[None]:
    """Run a block with another number of shuffle partitions."""
    if count is None:
        yield
        return
    with _setting(spark, "spark.sql.shuffle.partitions", str(count)):
        yield


@contextmanager
def short_splits(spark: SparkSession) -> Iterator[None]:
    """Run writes whose tasks read no more than they can hold.

    A task keeps what it shuffles, or sorts by day to write it, as rows, twenty times as
    large as in Parquet; what does not fit in its memory lies on disk as well. A smaller
    size of the session stays.
    """
    name = "spark.sql.files.maxPartitionBytes"
    if _bytes(spark.conf.get(name)) <= SPLIT_BYTES:
        yield
        return
    with _setting(spark, name, f"{SPLIT_BYTES}b"):
        yield


@contextmanager
def gathered_joins(spark: SparkSession) -> Iterator[None]:
    """Join two tables that are one partition each as they lie.

    By Spark's estimate for one day of a stored table, which is that of the whole table,
    both would soon be too large for a partition, and be shuffled.
    """
    with _setting(spark, "spark.sql.maxSinglePartitionBytes", f"{2**63 - 1}b"):
        yield


@contextmanager
def dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """Run writes whose shuffle files go as each write ends.

    Else they stay until the driver happens to collect its garbage, next to all that
    later steps write. The plan of a write is made for it alone: no other query reads them.
    """
    with _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        yield


# Scratch tables of this process in shared folders.
_SHARED_SCRATCH: list[tuple[SparkSession, str]] = []
# What is kept of scratch tables made from a DataFrame, for as long as it is in use.
KEPT: WeakKeyDictionary[DataFrame, list] = WeakKeyDictionary()


@atexit.register
def remove_scratch() -> None:
    """Delete the scratch tables in shared folders; at exit, or when all are done with.

    Those of a session that was stopped before are left to the folder's owner.
    """
    KEPT.clear()
    while _SHARED_SCRATCH:
        spark, path = _SHARED_SCRATCH.pop()
        if getattr(spark.sparkContext, "_jsc", None) is None:
            continue
        with suppress(Py4JError):  # the JVM may have ended first
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        path = f"{shared.rstrip('/')}/quotelake-{label}-{uuid.uuid4().hex}"
        _SHARED_SCRATCH.append((spark, path))
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix=f"quotelake-{label}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder
