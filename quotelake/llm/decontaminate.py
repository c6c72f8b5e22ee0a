"""Benchmark items in training texts: a BM25 index of items with block-max WAND.

The items are the index and every passage of every document is a query. A passage
is a window of words, twice as long as the longest item, at half its length from
the last: each item lies wholly within some passage. Impacts are divided by the
item's score against itself, so a passage that holds all of an item scores 1 and
one threshold serves long and short items. An item above it is verified: its
question and its answer must each share most of their five-word shingles with the
passage.

Postings lie in blocks of items with their highest impact. The words of a document
first bound all its passages at once; the blocks bound those that are left; and a
walk over the postings by pivots scores what these bounds cannot rule out.

A null or empty text has no passages. Items below ``SHINGLE`` words (or null) are no
more than phrases and are not searched; an empty answer asks for none. Items with
one text are all found. Repeated rows and null ids are searched as any other; other
columns are not looked at. Items are indexed on the driver in shards of bounded
size, one search for each.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import small_batches

K1, B = 1.2, 0.75
MIN_SCORE = 0.6
SHINGLE = 5
MIN_OVERLAP = 0.8
LEAST_HALF = 64
BLOCK_ITEMS = 16
# Characters of items in one shard of the index, which is sent to every worker.
SHARD_CHARS = 8_000_000

PUNCTUATION = b".,;:!?\"'()-"


class Leak(NamedTuple):
    item_id: int
    score: float
    question_overlap: float
    answer_overlap: float


def plain_words(text: str) -> list[bytes]:
    """Words as they are compared, in UTF-8: lower case, without punctuation."""
    return text.lower().encode("utf-8", "surrogatepass").translate(None, PUNCTUATION).split()


def split_item(text: str) -> tuple[str, str]:
    """Question and answer: the last line, or else the last sentence, answers."""
    body = text.strip()
    cut = body.rfind("\n")
    if cut < 0:
        ends = [m.end() for m in re.finditer(r"[.!?]\s+", body)]
        cut = ends[-1] if ends else len(body)
    return body[:cut], body[cut:]


def shingles(words: list[bytes]) -> set[tuple[bytes, ...]]:
    """Runs of ``SHINGLE`` words; a shorter text is one run."""
    if not words:
        return set()
    return {tuple(words[at : at + SHINGLE]) for at in range(max(1, len(words) - SHINGLE + 1))}


def overlap(part: list[bytes], passage: list[bytes]) -> float:
    """Share of the part's shingles that the passage holds; 1 for an empty part."""
    if not part:
        return 1.0
    if len(part) < SHINGLE:
        size = len(part)
        return float(any(passage[at : at + size] == part for at in range(len(passage) - size + 1)))
    own = shingles(part)
    return len(own & shingles(passage)) / len(own)


class Item(NamedTuple):
    item_id: int | None
    question: list[bytes]
    answer: list[bytes]

    def words(self) -> list[bytes]:
        return self.question + self.answer


class ItemIndex:
    """Search of items; an item goes by its place in ``items``."""

    def __init__(self, items: list[Item], in_documents: dict[bytes, int], documents: int, min_score: float = MIN_SCORE):
        """``in_documents`` has the number of documents, of all, with each word."""
        # Items of like length have like impacts, which makes the block bounds tight.
        self.items = sorted(items, key=lambda item: (len(item.words()), item.words(), str(item.item_id)))
        self.min_score = min_score
        bags = [Counter(item.words()) for item in self.items]
        sizes = np.array([sum(bag.values()) for bag in bags], float)
        self.half = max([LEAST_HALF, *(int(size) for size in sizes)])
        self.vocabulary = {word: place + 1 for place, word in enumerate(sorted(set().union(*bags)))}
        count, mean = len(bags), sizes.mean() if len(bags) else 1.0
        postings: list[list[tuple[int, float]]] = [[] for _ in range(len(self.vocabulary) + 1)]
        for place, bag in enumerate(bags):
            impacts = {}
            for word, n in bag.items():
                among = in_documents.get(word, 0)
                idf = np.log(1 + (documents - among + 0.5) / (among + 0.5))
                impacts[word] = idf * n * (K1 + 1) / (n + K1 * (1 - B + B * sizes[place] / mean))
            whole = sum(impacts.values())
            for word, impact in impacts.items():
                postings[self.vocabulary[word]].append((place, impact / whole))
        self.places = [np.array([place for place, _ in each], np.int64) for each in postings]
        self.impacts = [np.array([impact for _, impact in each]) for each in postings]
        self.most = np.array([each.max(initial=0) for each in self.impacts])
        # The most usual words are allowed for in full, so that only others need counting.
        usual, self.needed = [0], min_score
        for word in sorted(self.vocabulary, key=lambda word: -in_documents.get(word, 0)):
            term = self.vocabulary[word]
            if self.needed - self.most[term] < 2 / 3 * min_score:
                break
            self.needed -= self.most[term]
            usual.append(term)
        # Highest impact of each word in each block of items, as one sparse table.
        blocks = [place // BLOCK_ITEMS for place in self.places]
        tables = [np.unique(block, return_inverse=True) for block in blocks]
        self.block_low = np.concatenate([[0], np.cumsum([len(found) for found, _ in tables])])
        self.block_ids = np.concatenate([found for found, _ in tables]).astype(np.int64)
        self.block_most = np.zeros(len(self.block_ids))
        for low, (_, inside), impact in zip(self.block_low, tables, self.impacts):
            np.maximum.at(self.block_most, low + inside, impact)
        self.n_blocks = -(-count // BLOCK_ITEMS)
        self.block_sizes = np.diff(self.block_low)
        self.telling_sizes = self.block_sizes.copy()
        self.telling_sizes[usual] = 0

    def _entries(self, terms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Places in the table of block bounds, ``sizes`` for each of the terms."""
        return np.repeat(self.block_low[terms] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())

    def _open_blocks(self, terms: np.ndarray) -> np.ndarray:
        """Blocks whose bounds add up to the threshold for these distinct terms."""
        at = self._entries(terms, self.block_sizes[terms])
        bounds = np.bincount(self.block_ids[at], weights=self.block_most[at], minlength=self.n_blocks)
        return np.flatnonzero(bounds >= self.min_score)

    def _wand(self, terms: np.ndarray, open_blocks: np.ndarray) -> list[tuple[int, float]]:
        """Items at the threshold or above, by a walk over the postings of the terms."""
        found = []
        for block in open_blocks:
            start, end = block * BLOCK_ITEMS, (block + 1) * BLOCK_ITEMS
            cursors = []
            for term in terms.tolist():
                places = self.places[term]
                low, high = np.searchsorted(places, (start, end))
                if low < high:
                    impacts = self.impacts[term][low:high].tolist()
                    cursors.append([places[low:high].tolist(), impacts, 0, max(impacts)])
            while cursors:
                cursors.sort(key=lambda c: c[0][c[2]])
                bound, pivot = 0.0, None
                for cursor in cursors:
                    bound += cursor[3]
                    if bound >= self.min_score:
                        pivot = cursor[0][cursor[2]]
                        break
                if pivot is None:
                    break
                if cursors[0][0][cursors[0][2]] == pivot:
                    score = 0.0
                    for cursor in cursors:
                        if cursor[0][cursor[2]] != pivot:
                            break
                        score += cursor[1][cursor[2]]
                        cursor[2] += 1
                    if score >= self.min_score:
                        found.append((pivot, score))
                else:
                    for cursor in cursors:
                        while cursor[2] < len(cursor[0]) and cursor[0][cursor[2]] < pivot:
                            cursor[2] += 1
                cursors = [cursor for cursor in cursors if cursor[2] < len(cursor[0])]
        return found

    def passages(self, words: list[bytes]) -> Iterator[tuple[int, int, np.ndarray]]:
        """(start, end, distinct terms) of the passages that the words' bounds let through."""
        known = self.vocabulary.get
        terms = np.array([known(word, 0) for word in words], np.int64)
        # Bounds by half passage and block. Words count each time they come, so
        # these are no less than the true ones.
        halves = -(-len(words) // self.half)
        sizes = self.telling_sizes[terms]
        at = self._entries(terms, sizes)
        cell = np.repeat(np.arange(len(words)) // self.half * self.n_blocks, sizes) + self.block_ids[at]
        bounds = np.bincount(cell, weights=self.block_most[at], minlength=halves * self.n_blocks)
        bounds = bounds.reshape(halves, self.n_blocks)
        if halves > 1:
            bounds = bounds[:-1] + bounds[1:]
        for step in np.flatnonzero((bounds >= self.needed - 1e-9).any(axis=1)).tolist():
            start = step * self.half
            distinct = np.unique(terms[start : start + 2 * self.half])
            yield start, start + 2 * self.half, distinct[distinct > 0]

    def search(self, text: str | None) -> list[Leak]:
        """Verified items of a text, each with its best passage, by place."""
        words = plain_words(text or "")
        best: dict[int, Leak] = {}
        if not self.items or len(words) == 0:
            return []
        for start, end, terms in self.passages(words):
            for place, score in self._wand(terms, self._open_blocks(terms)):
                item, passage = self.items[place], words[start:end]
                shared = [overlap(part, passage) for part in (item.question, item.answer)]
                leak = Leak(item.item_id, min(1.0, score), *shared)
                if min(leak.question_overlap, leak.answer_overlap) >= MIN_OVERLAP:
                    known = best.get(place)
                    best[place] = max(known, leak, key=lambda x: x[1:]) if known else leak
        return [best[place] for place in sorted(best)]


def document_frequencies(documents: DataFrame, words: set[bytes]) -> tuple[dict[bytes, int], int]:
    """In how many documents each of the words is, and the number of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        rows = 0
        for batch in batches:
            rows += batch.num_rows
            for text in batch.column(0):
                counts.update(words.intersection(plain_words(text.as_py() or "")))
        kinds = (pa.binary(), pa.int64())
        columns = zip(*[(b"", rows), *counts.items()])
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["word", "n"])

    small_batches(documents.sparkSession)
    found = documents.select(F.col("text").cast("string")).mapInArrow(run, "word binary, n long")
    counts = {bytes(row.word): row.n for row in found.groupBy("word").agg(F.sum("n").alias("n")).toLocalIterator()}
    return counts, counts.pop(b"", 0)


def item_shards(items: DataFrame, documents: DataFrame, min_score: float = MIN_SCORE) -> Iterator[ItemIndex]:
    """Indexes of all items ``item_id, question, answer``, each of bounded size.

    Words weigh by the documents that hold them: what is usual there says little.
    """
    text = F.concat_ws(" ", "question", "answer")
    chars = items.agg(F.sum(F.length(text))).first()[0] or 0
    shards = 1 + chars // SHARD_CHARS
    rows = items.withColumn("shard", F.pmod(F.xxhash64(text), F.lit(shards)))
    for shard in range(shards):
        part = rows.where(F.col("shard") == shard).toLocalIterator()
        parsed = [Item(row.item_id, plain_words(row.question or ""), plain_words(row.answer or "")) for row in part]
        parsed = [item for item in parsed if len(item.words()) >= SHINGLE]
        words = {word for item in parsed for word in item.words()}
        yield ItemIndex(parsed, *document_frequencies(documents, words), min_score)


def as_items(benchmark: DataFrame) -> DataFrame:
    """``item_id, question, answer`` from items that are one text each."""

    @F.pandas_udf("question string, answer string")
    def parts(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([split_item(text or "") for text in texts], columns=["question", "answer"])

    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), parts(F.col("text").cast("string")).alias("p"))
    return rows.select("item_id", "p.question", "p.answer")


def find_leaks(documents: DataFrame, items: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap``: a row for each
    item that a document holds."""
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    small_batches(documents.sparkSession)
    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
    names = ["doc_id", *Leak._fields]

    def searched(index: ItemIndex) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0).to_pylist()
                rows = [(i, *leak) for i, text in zip(ids, batch.column(1)) for leak in index.search(text.as_py())]
                columns = list(zip(*rows)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)

        return texts.mapInArrow(run, "doc_id long, item_id long, score double, question_overlap double, answer_overlap double")

    found = [searched(index) for index in item_shards(items, documents, min_score)]
    whole = found[0]
    for part in found[1:]:
        whole = whole.unionByName(part)
    return whole


def clean_documents(documents: DataFrame, items: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents that hold no item, with all their columns, row by row."""
    small_batches(documents.sparkSession)
    clean = documents
    for index in item_shards(items, documents, min_score):
        clean = clean.where(~_holds(index)(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    return clean


def _holds(index: ItemIndex):
    @F.pandas_udf("boolean")
    def holds(texts: pd.Series) -> pd.Series:
        return pd.Series([bool(index.search(text)) for text in texts], dtype=bool)

    return holds
