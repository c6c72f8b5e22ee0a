"""A ranking kept between calls: sorted slices, and how many rows of a key each holds.

``ranked_page`` sorts or writes the whole table for every deep page. Here it is written
once, in slices by range of keys and order; a small table says, for each slice and key,
which ranks it holds. A page reads the slices that its ranks are in, and of those the rows
at their places, however deep it lies. A key that holds a third of all rows is many slices.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quotelake.operators.latest import total_order

# Names of the columns beside those of the table.
SLICE, PLACE, LOW, MANY, BEFORE = "_slice", "_place", "_low", "_many", "_before"


@dataclass(frozen=True)
class RankIndex:
    """A written ranking. ``keys`` are the columns it was written with."""

    path: str
    keys: tuple[str, ...] = ()

    @property
    def rows(self) -> str:
        return f"{self.path}/rows"

    @property
    def slices(self) -> str:
        return f"{self.path}/slices"


def write_rank_index(quotes: DataFrame, order: Sequence[Column], path: str, keys: Sequence[str] = ()) -> RankIndex:
    """Write the ranking of a table by ``order``, in each group of ``keys``, to a new path.

    Ties go as in ``ranked_page``. Null keys are a group as well.
    """
    index = RankIndex(path, tuple(keys))
    total = [*[F.col(key).asc_nulls_last() for key in keys], *total_order(quotes.columns, order)]
    # Behind the number of the partition, the id counts the rows of one task.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    sorted_rows = quotes.repartitionByRange(*total).sortWithinPartitions(*total)
    placed = sorted_rows.withColumns({PLACE: place, SLICE: F.spark_partition_id()})
    placed.write.partitionBy(SLICE).parquet(index.rows)
    spark = quotes.sparkSession
    stored = spark.read.schema(placed.schema).parquet(index.rows)
    # A key's rows are neighbours: a place and a number tell where they lie in a slice.
    held = stored.groupBy(SLICE, *keys).agg(F.min(PLACE).alias(LOW), F.count("*").alias(MANY))
    earlier = W.partitionBy(*keys).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    ranked = held.withColumn(BEFORE, F.coalesce(F.sum(MANY).over(earlier), F.lit(0)))
    ranked.write.parquet(index.slices)
    return index


def indexed_page(spark: SparkSession, index: RankIndex, *, page: int = 1, per_page: int = 50) -> DataFrame:
    """Page ``page`` of ``per_page`` rows of the ranking, in each group of its keys.

    Without keys the wanted slices, at most one for each row of the page, become a filter
    on folders and places. With keys they are joined.
    """
    if page < 1 or per_page < 1:
        raise ValueError("page and per_page start at 1")
    before, last = (page - 1) * per_page, page * per_page
    stored = spark.read.parquet(index.rows)
    names = [name for name in stored.columns if name not in (SLICE, PLACE)]
    slices = spark.read.parquet(index.slices)
    wanted = slices.where((F.col(BEFORE) < last) & (F.col(BEFORE) + F.col(MANY) > before))
    first_place = F.col(LOW) + F.greatest(F.lit(before) - F.col(BEFORE), F.lit(0))
    end_place = F.col(LOW) + F.least(F.lit(last) - F.col(BEFORE), F.col(MANY))
    spans = wanted.select(SLICE, *index.keys, first_place.alias("_first"), end_place.alias("_end"))
    if not index.keys:
        chosen = F.lit(False)
        for span in spans.collect():
            inside = (F.col(PLACE) >= span["_first"]) & (F.col(PLACE) < span["_end"])
            chosen = chosen | ((F.col(SLICE) == span[SLICE]) & inside)
        return stored.where(chosen).select(*names)
    # The places of a span are those of its key's rows.
    spans = spans.select(F.col(SLICE).alias("_in"), "_first", "_end")
    inside = (F.col(SLICE) == F.col("_in")) & (F.col(PLACE) >= F.col("_first")) & (F.col(PLACE) < F.col("_end"))
    return stored.join(spans, inside, "left_semi").select(*names)
