"""Ranking within groups: the latest row per key, and pages of a ranking.

A filter on ``row_number`` lets Spark cut every group before the shuffle: each
input task passes on at most as many rows per group as can be in the result.
A group that holds a third of all rows is therefore no load on its reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quotelake.schemas import SILVER_SCHEMA
from quotelake.session import KEPT, scratch_path

# Rows that tie in the order of a ranking are told apart by where they come from.
LINEAGE_ORDER = ("ingestion_time", "ingestion_run_id", "source_file")
# Without keys, ranks up to this are one sorted limit: one task holds so many rows.
SORTED_LIMIT_ROWS = 10_000


def ranking_order_names(names: Sequence[str], keys: Sequence[str], order: Sequence[str]) -> list[str]:
    """All columns but the keys: ``order``, lineage, then as in silver."""
    lineage = [c for c in LINEAGE_ORDER if c in names]
    known = [c for c in SILVER_SCHEMA.fieldNames() if c in names]
    others = sorted(c for c in names if c not in known)
    return [c for c in dict.fromkeys((*order, *lineage, *known, *others)) if c not in keys]


def ranking_order(names: Sequence[str], keys: Sequence[str], order: Sequence[str]) -> list[Column]:
    """``ranking_order_names``, the greatest first."""
    return [F.col(c).desc_nulls_last() for c in ranking_order_names(names, keys, order)]


def keep_latest(quotes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row per key that is greatest in ``order``, nulls last.

    Ties go to the greatest lineage, then to the greatest other columns in the
    order of the silver table: a task that runs again after a loss picks the same
    row, and so does every query that drops columns only afterwards.
    """
    ranking = W.partitionBy(*keys).orderBy(*ranking_order(quotes.columns, keys, order))
    return (
        quotes.withColumn("_rank", F.row_number().over(ranking))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def latest_per_day(quotes: DataFrame, keys: Sequence[str] = ("dt", "coin_id")) -> DataFrame:
    """The last quote of each coin and day."""
    return keep_latest(quotes, keys, _by_time(quotes))


def current_snapshot(latest: DataFrame, keys: Sequence[str] = ("coin_id",)) -> DataFrame:
    """The last quote of each coin; cheapest over the table of daily latest rows."""
    return keep_latest(latest, keys, _by_time(latest))


def dedup_quotes(
    quotes: DataFrame, keys: Sequence[str] = ("event_time_ts", "coin_id", "dt")
) -> DataFrame:
    """One row per coin and event time: the one updated, then ingested, last.

    The key with most values comes first: sorts compare its first eight bytes
    without looking at the row.
    """
    return keep_latest(quotes, keys, [c for c in ("last_updated_ts",) if c in quotes.columns])


def _by_time(quotes: DataFrame) -> list[str]:
    return [c for c in ("event_time_ts", "last_updated_ts") if c in quotes.columns]


def total_order(names: Sequence[str], order: Sequence[Column]) -> list[Column]:
    """``order``, then all columns: no two different rows tie."""
    return [*order, *[F.col(c).asc_nulls_last() for c in sorted(names)]]


def ranked_page(
    quotes: DataFrame,
    order: Sequence[Column],
    *,
    page: int = 1,
    per_page: int = 50,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Page ``page`` of ``per_page`` rows of a ranking, per group of ``keys``.

    Ties are told apart by all columns, so the pages together are every row once.
    With keys, groups are cut before the shuffle for ranks up to the session's
    ``spark.sql.optimizer.windowGroupLimitThreshold``, which ``SESSION_SETTINGS``
    raises. Without keys, a page behind ``SORTED_LIMIT_ROWS`` is found by counts in a sorted
    copy, which is made once for all pages of one DataFrame object: they are of the rows
    that it had then. ``quotelake.plans.write_rank_index`` keeps a ranking for later.
    """
    if page < 1 or per_page < 1:
        raise ValueError("page and per_page start at 1")
    before, last = (page - 1) * per_page, page * per_page
    total = total_order(quotes.columns, order)
    if keys:
        ranked = quotes.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*total)))
        return ranked.where(F.col("_rank").between(before + 1, last)).drop("_rank")
    if last <= SORTED_LIMIT_ROWS:
        return quotes.orderBy(*total).offset(before).limit(per_page)
    return _counted_page(quotes, total, before, last)


def _counted_page(quotes: DataFrame, total: Sequence[Column], before: int, last: int) -> DataFrame:
    """The rows of ranks behind ``before`` up to ``last``, by way of sorted slices.

    The counts of the slices tell which hold the wanted ranks, and only those rows are
    read again. Further pages of the same DataFrame and order read the same slices.
    """
    kept, ranking = KEPT.setdefault(quotes, []), quotes.orderBy(*total)
    slices = next((slices for known, slices in kept if known.sameSemantics(ranking)), None)
    if slices is None:
        slices = _sorted_slices(quotes, total)
        kept.append((ranking, slices))
    stored, counts = slices
    wanted, at = F.lit(False), 0
    for number, count in counts:
        if at < last and at + count > before:
            inside = F.col("_place").between(before - at, last - at - 1)
            wanted = wanted | ((F.col("_slice") == number) & inside)
        at += count
    return stored.where(wanted).select(*quotes.columns)


def _sorted_slices(quotes: DataFrame, total: Sequence[Column]) -> tuple[DataFrame, list[tuple[int, int]]]:
    """The rows written in slices by range of the order, and how many each slice has.

    Every row has its place in its slice. No task holds more than a slice.
    """
    path = scratch_path(quotes.sparkSession, "page")
    # Behind the number of the partition, the id counts the rows of one task.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    slices = quotes.repartitionByRange(*total).sortWithinPartitions(*total)
    slices = slices.withColumns({"_place": place, "_slice": F.spark_partition_id()})
    slices.write.partitionBy("_slice").parquet(path)
    stored = quotes.sparkSession.read.schema(slices.schema).parquet(path)
    return stored, sorted((row["_slice"], row["count"]) for row in stored.groupBy("_slice").count().collect())
