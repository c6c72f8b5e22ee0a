"""Periodic runs of words, found online by catchers over completed blocks.

Words ``[^\\x20\\x09-\\x0D]+`` are appended one after another. When a block of a power
of two of words is complete, a catcher compares it with the strings of its length that
begin from two to four times its length before it: a square of a period in that range
has such a block, whole, in its second half. A catch is a lag at which words repeat; while
the blocks that follow are caught at the same lag, the squares merge into one run. When
a block is missed, comparisons of words on either side of the caught ones, fewer than a
block, tell where the run begins and ends.

The catchers of one level work as arrays: all blocks that new words complete are compared
at once, strings by a name that combines those of their halves (64-bit hashes; before a
run is reported its words are compared). n words cost n log n steps, however periodic
they are, and one append may bring any number of words, with equal results. Documents
follow each other in one stream, with a word between them that equals no other.

A run is a stretch with smallest period q of ``least`` words and ``exponent`` times q or
more, that no neighbouring word extends. ``collapsed`` has the text's words but those
of a run beyond its first q. A null or empty text has no words and no runs. Repeated
rows and null ids get a row each; an empty table gives none. Columns but ``doc_id`` and
``text`` are not looked at. Texts are split as a whole: a task holds the words of one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import small_batches

EXPONENT = 4
LEAST = 6
# Documents are appended to one stream until it has so many words.
STREAM_WORDS = 250_000
# So many comparisons of words or names are made at once.
AT_ONCE = 1 << 22

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"

# Multipliers that mix 64 bits.
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(names: np.ndarray) -> np.ndarray:
    names = (names ^ (names >> np.uint64(30))) * MIX[0]
    return (names ^ (names >> np.uint64(27))) * MIX[1] | np.uint64(1)


class Level:
    """Catchers of blocks of ``size`` words, for lags from ``low`` to ``high`` - 1."""

    def __init__(self, size: int, low: int, high: int):
        self.size, self.low, self.high = size, low, high
        # Names of the strings that begin at ``first`` and after; 0 stands before the stream.
        self.names, self.first = np.zeros(high, np.uint64), -high
        self.block = 0
        # Lags at which the last complete block was caught, and their first blocks.
        self.lag, self.since = np.zeros((2, 0), np.int64)

    def advance(self, new: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Catch the blocks that ``new`` names complete: lag, first and last block of
        every chain of catches that has ended."""
        self.names = np.concatenate([self.names, new])
        size, lags = self.size, self.high - self.low
        known = self.first + len(self.names)
        blocks = max(0, -(-known // size) - self.block) if known > 0 else 0
        lag, since, last = [self.lag], [self.since], [np.full(len(self.lag), self.block - 1)]
        step = max(1, AT_ONCE // lags)
        for begin in range(self.block, self.block + blocks, step):
            many = min(step, self.block + blocks - begin)
            own = self.names[begin * size - self.first :][: (many - 1) * size + 1 : size]
            # Row by row the strings that begin from ``high`` - 1 to ``low`` words before.
            at = begin * size - self.high + 1 - self.first
            before = np.lib.stride_tricks.as_strided(
                self.names[at:], (many, lags), (size * self.names.itemsize, self.names.itemsize), writeable=False
            )
            caught, place = np.nonzero(before == own[:, None])
            lag.append(self.high - 1 - place)
            since.append(begin + caught)
            last.append(begin + caught)
        self.block += blocks
        lag, since, last = (np.concatenate(each) for each in (lag, since, last))
        order = np.lexsort((since, lag))
        lag, since, last = lag[order], since[order], last[order]
        heads = np.ones(len(lag), bool)
        heads[1:] = (lag[1:] != lag[:-1]) | (since[1:] != last[:-1] + 1)
        tails = np.append(heads[1:], True)[: len(heads)]
        lag, since, last = lag[heads], since[heads], last[tails]
        going = last == self.block - 1
        self.lag, self.since = lag[going], since[going]
        # Blocks to come look back by ``high`` words.
        spare = min(len(self.names), self.block * size - self.high - self.first)
        if spare > 0:
            self.names, self.first = self.names[spare:], self.first + spare
        return lag[~going], since[~going], last[~going]

    def close(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Chains that go on to the end of the stream."""
        lag, since = self.lag, self.since
        self.lag, self.since = np.zeros((2, 0), np.int64)
        return lag, since, np.full(len(lag), self.block - 1)


class RunCatcher:
    """A stream of words (whole numbers) and the runs found in it so far.

    ``longest`` bounds the length of a run, as a document's length does; periods
    beyond its share of that have no catchers.
    """

    def __init__(self, exponent: int = EXPONENT, least: int = LEAST, longest: int | None = None):
        self.exponent, self.least, self.longest = exponent, least, longest
        self.words = np.zeros(0, np.int64)
        self.levels = [Level(1, 1, 2)]
        # Names that the next level still pairs, by level, and where they begin.
        self.halves: list[np.ndarray] = []
        self.found: list[np.ndarray] = [np.zeros((0, 3), np.int64)]

    def _most(self) -> int:
        """The largest period that words so far leave room for."""
        room = len(self.words) if self.longest is None else min(self.longest, len(self.words))
        return room // self.exponent

    def append(self, words: np.ndarray) -> None:
        self.words = np.concatenate([self.words, np.asarray(words, np.int64)])
        names = _mixed(self.words[len(self.words) - len(words) :].astype(np.uint64))
        self._ended(self.levels[0], self.levels[0].advance(names))
        size, at = 1, 1
        while 2 * size <= self._most() or at < len(self.levels):
            if at == len(self.levels):
                # A new level starts with all strings of its length so far.
                self.levels.append(Level(size, 2 * size, 4 * size))
                names = self._names(size)
                self.halves.append(np.zeros(0, np.uint64))
            self._ended(self.levels[at], self.levels[at].advance(names))
            whole = np.concatenate([self.halves[at - 1], names])
            names = _mixed(whole[: max(0, len(whole) - size)] * MIX[1] + whole[size:])
            self.halves[at - 1] = whole[max(0, len(whole) - size) :]
            size, at = 2 * size, at + 1

    def _names(self, size: int) -> np.ndarray:
        names, half = _mixed(self.words.astype(np.uint64)), 1
        while half < size:
            names = _mixed(names[: max(0, len(names) - half)] * MIX[1] + names[half:])
            half *= 2
        return names

    def close(self) -> np.ndarray:
        """All runs, as rows of start, length and period, by start and period."""
        for level in self.levels:
            self._ended(level, level.close())
        runs = np.concatenate(self.found)
        runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
        # A multiple of a period has the same stretch: the smallest stays.
        first = np.ones(len(runs), bool)
        first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
        runs = runs[first]
        return runs[np.lexsort((runs[:, 2], runs[:, 0]))]

    def _ended(self, level: Level, chains: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
        lag, since, last = chains
        size = level.size
        start, end = since * size, (last + 1) * size
        # Fewer than a block is to come on either side.
        need = np.maximum((self.exponent - 1) * lag, self.least - lag)
        able = end - start + 2 * (size - 1) >= need
        lag, start, end = lag[able], np.maximum(start, lag)[able], end[able]
        if len(lag):
            inside = self._within_known(lag, start - lag, end)
            lag, start, end = lag[~inside], start[~inside], end[~inside]
        if not len(lag):
            return
        start -= self._equal(start - 1, lag, -1, size)
        end += self._equal(end, lag, 1, size)
        able = end - start >= np.maximum((self.exponent - 1) * lag, self.least - lag)
        rows = [row for each in zip(lag[able].tolist(), start[able].tolist(), end[able].tolist()) for row in self._checked(*each)]
        if rows:
            self.found.append(np.array(rows, np.int64))

    def _within_known(self, lag: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Stretches inside a run whose period divides the lag: they end where it does."""
        runs = np.concatenate(self.found)
        if not len(runs):
            return np.zeros(len(lag), bool)
        runs = runs[np.argsort(runs[:, 0], kind="stable")]
        ends = runs[:, 0] + runs[:, 1]
        far = np.maximum.accumulate(ends)
        # Of the runs that begin no later the one that ends last.
        owner = np.maximum.accumulate(np.where(ends == far, np.arange(len(runs)), 0))
        at = np.searchsorted(runs[:, 0], start, "right") - 1
        own = owner[np.maximum(at, 0)]
        return (at >= 0) & (ends[own] >= end) & (lag % runs[own, 2] == 0)

    def _equal(self, at: np.ndarray, lag: np.ndarray, step: int, most: int) -> np.ndarray:
        """How many words from ``at`` on, in steps, equal those ``lag`` before; ``most`` are looked at."""
        words, found = self.words, np.zeros(len(at), np.int64)
        many = max(1, AT_ONCE // most)
        reach = step * np.arange(most)
        for begin in range(0, len(at), many):
            cut = slice(begin, begin + many)
            place = at[cut, None] + reach
            there = (place < len(words)) & (place >= lag[cut, None])
            place = np.where(there, place, lag[cut, None])
            equal = there & (words[np.minimum(place, len(words) - 1)] == words[place - lag[cut, None]])
            found[cut] = np.where(equal.all(axis=1), most, equal.argmin(axis=1))
        return found

    def _checked(self, lag: int, start: int, end: int) -> Iterator[tuple[int, int, int]]:
        """Runs (start, length, period) in a stretch where names say that words repeat."""
        same = self.words[start:end] == self.words[start - lag : end - lag]
        if same.all():
            yield start - lag, end - start + lag, lag
            return
        edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
        for low, high in edges.reshape(-1, 2).tolist():
            if high - low >= max((self.exponent - 1) * lag, self.least - lag):
                yield start + low - lag, high - low + lag, lag


def runs_of(documents: list[list[bytes]], exponent: int = EXPONENT, least: int = LEAST) -> list[np.ndarray]:
    """Runs of each document's words, as rows of start, length and period."""
    known: dict[bytes, int] = {}
    number = count(1)
    sizes = np.array([len(words) for words in documents], np.int64)
    begin = np.cumsum(sizes + 1) - sizes - 1
    catcher = RunCatcher(exponent, least, int(sizes.max(initial=0)))
    stream = np.zeros(int(sizes.sum()) + len(sizes), np.int64)
    for words, at in zip(documents, begin.tolist()):
        stream[at : at + len(words)] = np.fromiter(map(known.setdefault, words, number), np.int64, len(words))
    stream[begin + sizes] = -1 - np.arange(len(sizes))
    catcher.append(stream)
    runs = catcher.close()
    cuts = np.searchsorted(runs[:, 0], np.append(begin, len(stream)))
    return [runs[a:b] - [at, 0, 0] for a, b, at in zip(cuts[:-1], cuts[1:], begin.tolist())]


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those of a run beyond its first period."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return b" ".join(compress(words, (np.cumsum(change[:-1]) == 0).tolist()))


def find_runs(documents: DataFrame, exponent: int = EXPONENT, least: int = LEAST) -> DataFrame:
    """``doc_id, n_words, runs, collapsed``: runs by start and period, starts as word numbers."""

    def rows(ids: list[int | None], held: list[list[bytes]]) -> pa.RecordBatch:
        found = runs_of(held, exponent, least)
        flat = np.concatenate([np.zeros((0, 3), np.int64), *found])
        offsets = np.cumsum([0, *map(len, found)])
        items = pa.StructArray.from_arrays([pa.array(flat[:, side]) for side in range(3)], fields=list(RUN))
        columns = [
            pa.array(ids, pa.int64()),
            pa.array([len(words) for words in held], pa.int64()),
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items),
            pa.array([collapse(words, runs) for words, runs in zip(held, found)], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, held, size = [], [], 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = text.as_py().split()
                if held and size + len(words) > STREAM_WORDS:
                    yield rows(ids, held)
                    ids, held, size = [], [], 0
                ids.append(key)
                held.append(words)
                size += len(words)
            if held:
                yield rows(ids, held)

    small_batches(documents.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    found = documents.select(F.col("doc_id").cast("long"), text).mapInArrow(run, SCHEMA)
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))
