"""Files: landed API pages, JSON event lines, partitioned Parquet tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from quotelake.functions import utc_literal
from quotelake.schemas import (
    CORRUPT_RECORD,
    PAGE_SCHEMA,
    RECORD_TEXT,
    bronze_schema,
    with_corrupt_record,
)
from quotelake.sources.lines import event_rows


def _json_reader(reader, schema: T.StructType, multi_line: bool = False):
    return (
        reader.schema(with_corrupt_record(schema))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_RECORD)
        .option("multiLine", multi_line)
        # The sink's partition=N folders are no column of an event. Without this
        # a stream started on an empty folder ends when the first one appears.
        .option("recursiveFileLookup", True)
    )


def _paged(files: DataFrame) -> DataFrame:
    names = PAGE_SCHEMA.fieldNames()
    any_field = F.coalesce(*[F.col(c).cast("string") for c in names]).isNotNull()
    return files.where(F.col(CORRUPT_RECORD).isNull() | any_field).select(
        *names,
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("landed_at"),
    )


def read_pages(spark: SparkSession, path: str, *, page_per_file: bool = False) -> DataFrame:
    """One row per coin object of landed API pages, each page a JSON array.

    A file holds one page per line, or one page in all with ``page_per_file``.
    ``landed_at`` is when the file was last written; a copy has another one.
    Unreadable pages give no rows.
    """
    return _paged(_json_reader(spark.read, PAGE_SCHEMA, page_per_file).json(path))


def stream_pages(
    spark: SparkSession,
    path: str,
    *,
    page_per_file: bool = False,
    files_per_batch: int | None = None,
) -> DataFrame:
    reader = _json_reader(spark.readStream, PAGE_SCHEMA, page_per_file)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _paged(reader.json(path))


def _with_lineage(files: DataFrame, schema: T.StructType, ingestion_time: Column) -> DataFrame:
    lines = files.select("value", F.col("_metadata.file_path").alias("source_file"))
    rows = event_rows(lines, schema).withColumn("ingestion_time", ingestion_time)
    lineage = ("source_file", "ingestion_time", RECORD_TEXT)
    return rows.select(*schema.fieldNames(), CORRUPT_RECORD, *lineage)


def _line_reader(reader):
    # The sink's partition=N folders are no column of an event. Without this
    # a stream started on an empty folder ends when the first one appears.
    return reader.schema("value string").option("recursiveFileLookup", True)


def _make_folder(spark: SparkSession, path: str) -> None:
    """A folder for lines that are still to land; a stream of text wants it there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def read_events(
    spark: SparkSession,
    path: str | list[str],
    *,
    ingested_at: datetime | None = None,
    integral_amounts: bool = False,
) -> DataFrame:
    """Raw events from JSON lines, with their file and one ingestion time per run.

    ``event_rows`` says what bad lines and fields become.
    """
    schema = bronze_schema(integral_amounts=integral_amounts)
    run_time = utc_literal(ingested_at or datetime.now(timezone.utc))
    return _with_lineage(_line_reader(spark.read).text(path), schema, run_time)


def stream_events(
    spark: SparkSession,
    path: str,
    *,
    files_per_batch: int | None = None,
    bytes_per_batch: str | None = None,
    integral_amounts: bool = False,
) -> DataFrame:
    """``read_events`` as a stream; each micro-batch has one ingestion time."""
    schema = bronze_schema(integral_amounts=integral_amounts)
    _make_folder(spark, path)
    reader = _line_reader(spark.readStream)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return _with_lineage(reader.text(path), schema, F.current_timestamp())


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table as it is stored; None while there is no file to tell."""
    try:
        return spark.read.parquet(path)
    except (PySparkException, Py4JJavaError):
        # No file, or none to read: reading rows will tell.
        return None


def _schema_as_stored(schema: T.StructType, stored: DataFrame | None) -> T.StructType:
    """The schema with longs where the table stores longs for doubles.

    Earlier deployments wrote amounts as longs. A table has one type throughout:
    ``LakeConfig.integral_amounts`` goes on writing longs to such a one.
    """
    kinds = {} if stored is None else {f.name: f.dataType for f in stored.schema}
    long, double = T.LongType(), T.DoubleType()
    return T.StructType(
        [
            T.StructField(f.name, long) if f.dataType == double and kinds.get(f.name) == long else f
            for f in schema
        ]
    )


def _typed(table: DataFrame, schema: T.StructType) -> DataFrame:
    return table.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """A Parquet table; filters on its partition column ``dt`` prune folders.

    With a schema, an empty table reads as no rows, columns come in the schema's
    order instead of with the partition column last, and amounts stored as longs
    come as doubles.
    """
    if schema is None:
        return spark.read.parquet(path)
    stored = _stored(spark, path)
    if stored is not None and set(schema.fieldNames()) <= set(stored.columns):
        return _typed(stored, schema)
    return _typed(spark.read.schema(_schema_as_stored(schema, stored)).parquet(path), schema)


def stream_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    files_per_batch: int | None = None,
) -> DataFrame:
    """``read_table`` as a stream of the rows of new files."""
    stored = _schema_as_stored(schema, _stored(spark, path))
    # The partition column last, where Spark puts it once there are folders.
    reader = spark.readStream.schema(
        T.StructType(sorted(stored.fields, key=lambda field: field.name == "dt"))
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _typed(reader.parquet(path), schema)
