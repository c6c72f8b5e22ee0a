"""Work on the days of a stored table where they lie, without a shuffle.

A table in folders by day holds a day's rows together already. What is keyed by day and
coin needs no more than that: a task reads a few small days whole, or a share of the coins
of a large one, and writes its result to the same days.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.sinks import cluster_by_day

# A task holds its rows at once, some 600 bytes each with what is made of them.
TASK_ROWS = 1_000_000
# Fewer are not worth a task of their own.
LEAST_ROWS = 100_000
# Each task of a large day reads all of it: with more, a shuffle costs less.
MOST_READS = 8
# Each task of a job is a part of its plan.
MOST_TASKS = 100

Work = Callable[..., DataFrame]


def day_jobs(table: DataFrame, work: Work, *beside: DataFrame) -> Iterator[DataFrame]:
    """``work`` on a table in folders by day, as one or more tables of different days.

    Tables ``beside`` it, in folders by day as well and no larger, are given to ``work`` after
    it, with the same days and coins; only days of ``table`` are worked on.
    ``work`` has to be by ``dt`` and ``coin_id``, or by more columns with them. Each day is
    in few partitions, so it is written without a further shuffle. Rows are counted first,
    which reads no column. Days too large for ``MOST_READS`` tasks are shuffled, where
    ``work`` can cut hot keys before.
    """
    counts = dict(table.groupBy(_day().alias("day")).count().collect())
    large = [day for day, rows in counts.items() if rows > MOST_READS * TASK_ROWS]
    if large or not counts:
        known = [day for day in large if day is not None]
        rest = _day().isNull() if None in large else F.lit(False)
        yield cluster_by_day(work(*[t.where(_day().isin(known) | rest) if large else t for t in (table, *beside)]))
    near = {day: rows for day, rows in counts.items() if day not in large}
    tasks: list[Column] = []
    for together in _day_tasks(near, table.sparkSession.sparkContext.defaultParallelism):
        # The tasks of a day stay in one job: a later one would replace the day.
        if tasks and len(tasks) + len(together) > MOST_TASKS:
            yield _in_tasks((table, *beside), work, tasks)
            tasks = []
        tasks += together
    if tasks:
        yield _in_tasks((table, *beside), work, tasks)


def _day_tasks(counts: dict[int | None, int], cores: int) -> Iterator[list[Column]]:
    """The rows of each task; those of tasks that share a day together."""
    room = min(TASK_ROWS, max(LEAST_ROWS, -(-sum(counts.values()) // cores)))
    group: list[int] = []
    held = 0
    for day in sorted(counts, key=lambda day: (day is None, day)):
        rows = counts[day]
        alone = day is None or rows > TASK_ROWS
        if group and (alone or held + rows > room):
            yield [_day().isin(group)]
            group, held = [], 0
        if alone:
            shares = max(1, -(-rows // TASK_ROWS))
            inside = _day().isNull() if day is None else _day() == day
            yield [inside & (_share(shares) == number) for number in range(shares)]
        else:
            group.append(day)
            held += rows
    if group:
        yield [_day().isin(group)]


def _day() -> Column:
    """The day as a number: the driver can hold those of any year."""
    return F.unix_date(F.col("dt").try_cast("date"))


def _share(shares: int) -> Column:
    return F.pmod(F.xxhash64(F.col("coin_id").cast("string")), F.lit(shares))


def _in_tasks(tables: Sequence[DataFrame], work: Work, tasks: list[Column]) -> DataFrame:
    """``work`` on the rows of each task; one partition suits whatever it groups by."""
    # The second number keeps the parts apart: Spark may lay single partitions together.
    parts = [work(*[t.where(rows).coalesce(1) for t in tables]).coalesce(2) for rows in tasks]
    return reduce(DataFrame.union, parts)
