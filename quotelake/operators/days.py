"""Restricting a table to the days a batch touches, as ranges of days.

However many days there are, neighbouring ones are one range, and a filter on
ranges prunes the partitions of a table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# First and last day, both included.
DayRange = tuple[date, date]

ONE_DAY = timedelta(days=1)


def day_ranges(days: Iterable[date]) -> list[DayRange]:
    """The days as sorted ranges without gaps; repeated days count once."""
    ranges: list[DayRange] = []
    for day in sorted(set(days)):
        if ranges and day - ranges[-1][1] == ONE_DAY:
            ranges[-1] = (ranges[-1][0], day)
        else:
            ranges.append((day, day))
    return ranges


def touched_days(batch: DataFrame) -> list[DayRange]:
    """The days of a batch, as ranges.

    Ranges are found within each year, in Spark, and joined across years here.
    """
    days = batch.select("dt").where(F.col("dt").isNotNull()).distinct()
    place = F.row_number().over(W.partitionBy(F.year("dt")).orderBy("dt"))
    islands = days.withColumn("island", F.date_sub("dt", place)).groupBy(F.year("dt"), "island")
    found = islands.agg(F.min("dt").alias("first"), F.max("dt").alias("last")).collect()
    ranges: list[DayRange] = []
    for row in sorted(found, key=lambda row: row["first"]):
        if ranges and row["first"] - ranges[-1][1] == ONE_DAY:
            ranges[-1] = (ranges[-1][0], row["last"])
        else:
            ranges.append((row["first"], row["last"]))
    return ranges


def cut_ranges(ranges: Sequence[DayRange], size: int) -> Iterator[list[DayRange]]:
    """Groups of ranges with ``size`` days in all; the last may have fewer."""
    group: list[DayRange] = []
    room = size
    for first, last in ranges:
        while first <= last:
            end = min(last, first + timedelta(days=room - 1))
            group.append((first, end))
            room -= (end - first).days + 1
            first = end + ONE_DAY
            if not room:
                yield group
                group, room = [], size
    if group:
        yield group


def is_in_days(ranges: Sequence[DayRange]) -> Column:
    """Whether ``dt`` is in one of the ranges; never for none."""
    single = [first for first, last in ranges if first == last]
    tests = [F.col("dt").isin(single)] if single else []
    tests += [F.col("dt").between(first, last) for first, last in ranges if first != last]
    return _any(tests) if tests else F.lit(False)


def _any(tests: Sequence[Column]) -> Column:
    """The tests joined as a balanced tree, which stays flat for very many."""
    if len(tests) == 1:
        return tests[0]
    half = len(tests) // 2
    return _any(tests[:half]) | _any(tests[half:])


def in_days(table: DataFrame, days: Sequence[DayRange] | None) -> DataFrame:
    """Rows of the given days, of all for None; prunes the table's partitions."""
    return table if days is None else table.where(is_in_days(days))


def last_day(days: Sequence[DayRange]) -> date | None:
    return max((last for _, last in days), default=None)
