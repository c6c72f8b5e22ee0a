"""Many small history files as few large ones.

Streams write a file for each poll and task. A compaction packs the small files of each
day into bins of about ``target_bytes`` and writes each bin as one file beside the
history, never into it: a stream over the history sees no row twice. What has been packed
is one table of file names, written last. Readers take the packed files of complete
compactions and those history files that no complete one holds, so they see every row
once at any moment, and a run that is cut in the middle changes nothing for them.

Packed files are small files to later runs while they are below the target: days that
still grow are packed again, and the older packing is set aside in the same list.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.config import LakeConfig
from quotelake.operators import in_days
from quotelake.operators.days import DayRange
from quotelake.schemas import SILVER_SCHEMA

TARGET_BYTES = 256 * 1024 * 1024
# Names of files that stand packed elsewhere, and of the run that packed them.
PACKED_SCHEMA = "dt date, path string, run string"


def _folder_of(config: LakeConfig, run: str) -> str:
    return f"{config.compacted}/files/run={run}"


def _list_of(config: LakeConfig) -> str:
    return f"{config.compacted}/packed"


def _packed(spark: SparkSession, config: LakeConfig) -> DataFrame:
    try:
        return spark.read.schema(PACKED_SCHEMA).parquet(_list_of(config))
    except AnalysisException:
        return spark.createDataFrame([], PACKED_SCHEMA)


def _listed(spark: SparkSession, path: str) -> DataFrame:
    """``path, file, length`` of Parquet files, ``file`` as rows name it; none is opened."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
        return files.load(path).select("path", F.col("_metadata.file_path").alias("file"), "length")
    except AnalysisException:
        return spark.createDataFrame([], "path string, file string, length long")


def live_files(spark: SparkSession, config: LakeConfig) -> DataFrame:
    """``dt, path, file, length`` of the files that together hold every row of the history once."""
    packed = _packed(spark, config)
    runs = packed.select("run").distinct()
    written = _listed(spark, f"{config.compacted}/files").withColumn("run", F.regexp_extract("path", r"/run=([^/]+)/", 1))
    files = _listed(spark, config.history).unionByName(written.join(runs, "run", "left_semi").drop("run"))
    return files.join(packed.select("path"), "path", "left_anti").select(_day_of("path"), "path", "file", "length")


def _day_of(path: str) -> Column:
    return F.regexp_extract(path, r"/dt=([^/]+)/", 1).try_cast("date").alias("dt")


def bins(files: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """``dt, path, bin`` of the files worth packing.

    Files below half the target count as small; those of a day are laid end to end, the
    smallest first, and cut at multiples of the target, so that a bin has at most one
    and a half times the target. A small file alone in its bin stays where it is.
    """
    small = files.where(F.col("length") < target_bytes // 2)
    row = W.partitionBy("dt").orderBy("length", "path").rowsBetween(W.unboundedPreceding, W.currentRow)
    before = F.sum("length").over(row) - F.col("length")
    cut = small.withColumn("bin", F.floor(before / target_bytes).cast("long"))
    many = F.count("*").over(W.partitionBy("dt", "bin"))
    return cut.withColumn("many", many).where("many > 1").select("dt", "path", "file", "bin")


def _read_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The rows of these files with their ``file``; its folder tells the day, or null."""
    stored = T.StructType([field for field in SILVER_SCHEMA if field.name != "dt"])
    if not paths:
        return spark.createDataFrame([], SILVER_SCHEMA).withColumn("file", F.lit(""))
    file = F.col("_metadata.file_path").alias("file")
    return spark.read.schema(stored).parquet(*paths).select(_day_of("_metadata.file_path"), *stored.fieldNames(), file)


def read_history(spark: SparkSession, config: LakeConfig, days: Sequence[DayRange] | None = None) -> DataFrame:
    """Every row of the history once, of all days or of some, from packed files where there are any.

    The names of the live files of those days go through the driver, as those of any
    table do when Spark lists it.
    """
    paths = [row["path"] for row in in_days(live_files(spark, config), days).select("path").collect()]
    return _read_files(spark, paths).select(*SILVER_SCHEMA.fieldNames())


def is_packed(spark: SparkSession, config: LakeConfig) -> bool:
    return bool(_packed(spark, config).take(1))


def compact_history(spark: SparkSession, config: LakeConfig, *, target_bytes: int = TARGET_BYTES) -> int:
    """Pack the small files of every day; how many files were packed.

    One compaction runs at a time. Polls and streams go on meanwhile: what they add is
    in no bin of this run.
    """
    names = bins(live_files(spark, config), target_bytes).collect()
    if not names:
        return 0
    run = uuid.uuid4().hex
    placed = spark.createDataFrame(names, "dt date, path string, file string, bin long")
    rows = _read_files(spark, [row["path"] for row in names]).join(placed.select("file", "bin"), "file")
    # A bin is one task's, and one file in a folder of its own.
    rows = rows.drop("file").repartition("dt", "bin").sortWithinPartitions("dt", "bin")
    rows.write.partitionBy("dt", "bin").parquet(_folder_of(config, run))
    # From here on readers see the packed files instead.
    placed.select("dt", "path", F.lit(run).alias("run")).coalesce(1).write.mode("append").parquet(_list_of(config))
    return len(names)
