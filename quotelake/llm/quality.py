"""Quality rules: lengths, repetition, and divergence from a language's usual text.

For each language the whole table gives a reference: a histogram of character
classes and one of its most common words. A document is compared with that of
its language by Jensen-Shannon distance (base 2, 0 to 1), or with the closest one
where its language is null or has no reference. Short documents are noise:
guards leave the verdict to the base rules below a length, and the allowance for
common words shrinks with the root of the number of words.

A null or empty text has no words and fails the base rules. Repeated rows and null
ids get a row each. Without any reference the base rules alone decide. Words are
split at ASCII white space; common words ignore ASCII case and punctuation.
Columns other than ``doc_id``, ``text`` and ``lang`` are not looked at.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotelake.llm.common import give_back, small_batches

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW_WORDS = 8
SYMBOLS = b"#*$%&|<>"
PUNCTUATION = b".,;:!?\"'()-"

MIN_CLASS_CHARS = 200
MAX_CLASS_DISTANCE = 0.3
MIN_COMMON_WORDS = 50
# The allowance is the base plus the part by the root of the number of words.
MAX_WORD_DISTANCE, WORD_NOISE = 0.2, 1.5

COMMON_WORDS = 30
# A language with so many words has a reference, of some 40 rows on the driver.
REFERENCE_WORDS = 10_000
# A task hands its counts on when it holds so many words.
HELD_WORDS = 150_000

CLASSES = ("lower", "upper", "digit", "space", "line", "punctuation", "symbol", "other")


def _byte_classes() -> np.ndarray:
    """Class of each byte; continuation bytes have none (8), so characters count once."""
    table = np.full(256, CLASSES.index("symbol"))
    table[ord("a") : ord("z") + 1] = CLASSES.index("lower")
    table[ord("A") : ord("Z") + 1] = CLASSES.index("upper")
    table[ord("0") : ord("9") + 1] = CLASSES.index("digit")
    table[[9, 11, 12, 13, 32]] = CLASSES.index("space")
    table[10] = CLASSES.index("line")
    table[list(PUNCTUATION)] = CLASSES.index("punctuation")
    table[0x80:0xC0] = len(CLASSES)
    table[0xC0:] = CLASSES.index("other")
    return table


BYTE_CLASSES = _byte_classes()
BLANKS = [9, 10, 11, 12, 13, 32]


def common_form(text: bytes) -> list[bytes]:
    """The words as they are compared: lower case, without punctuation."""
    return text.lower().translate(None, PUNCTUATION).split()


def js_distance(one: np.ndarray, other: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms; 1 if either is empty."""
    if not one.sum() or not other.sum():
        return 1.0
    p, q = one / one.sum(), other / other.sum()
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        gap = np.where(p > 0, p * np.log2(p / middle), 0) + np.where(q > 0, q * np.log2(q / middle), 0)
    return float(np.sqrt(min(1.0, max(0.0, gap.sum() / 2))))


def repeated_words(words: list[bytes], width: int = WINDOW_WORDS) -> int:
    """Words in windows of ``width`` words that occur twice or more in the text."""
    windows = len(words) - width + 1
    if windows < 2:
        return 0
    names: dict[bytes, int] = {}
    ids = np.array([names.setdefault(word, len(names)) for word in words], np.int64)
    if len(names) == len(words):
        return 0
    # Windows of 2, 4, ... words are numbered in turn, until none occurs twice.
    done = 1
    while done < width:
        step = min(done, width - done)
        pairs = ids[: len(ids) - step] * (len(words) + 1) + ids[step:]
        done += step
        order = np.sort(pairs)
        if not (order[1:] == order[:-1]).any():
            return 0
        ids = np.unique(pairs, return_inverse=True)[1]
    twice = np.bincount(ids)[ids] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:windows] += twice
    edges[width : width + windows] -= twice
    return int((np.cumsum(edges)[:-1] > 0).sum())


@dataclass(frozen=True)
class Reference:
    classes: np.ndarray
    places: dict[bytes, int]
    words: np.ndarray

    def class_distance(self, counts: np.ndarray) -> float:
        return js_distance(counts, self.classes)

    def word_distance(self, words: list[bytes]) -> float:
        rest = len(self.places)
        counts = np.bincount([self.places.get(word, rest) for word in words], minlength=rest + 1)
        return js_distance(counts, self.words)


def histograms(documents: DataFrame) -> DataFrame:
    """``lang, kind, name, n`` over all documents: classes, words, their total."""

    def sent(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(zip(*rows), (pa.string(),) * 3 + (pa.int64(),))
        return pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in columns], names=["lang", "kind", "name", "n"])

    def counted(words: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, counter in words.items():
            rows = [(lang, "word", w.decode("utf-8", "replace"), n) for w, n in counter.items() if _has_letter(w)]
            for at in range(0, len(rows), 50_000):
                yield sent(rows[at : at + 50_000])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = defaultdict(lambda: np.zeros(len(CLASSES) + 1, np.int64))
        words: dict[str, Counter] = defaultdict(Counter)
        totals: Counter = Counter()
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = text.as_py() or b""
                counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
                classes[lang] += np.bincount(BYTE_CLASSES, weights=counts).astype(np.int64)
                common = common_form(raw)
                totals[lang] += len(common)
                words[lang].update(common)
            if sum(map(len, words.values())) > HELD_WORDS:
                yield from counted(words)
                words.clear()
                give_back()
        rows = [(lang, "class", name, int(n)) for lang, all_n in classes.items() for name, n in zip(CLASSES, all_n)]
        rows += [(lang, "total", "", n) for lang, n in totals.items()]
        if rows:
            yield sent(rows)
        yield from counted(words)
        words.clear()
        give_back()

    small_batches(documents.sparkSession)
    rows = documents.where("lang is not null").select(
        F.col("lang").cast("string"), F.col("text").cast("string").cast("binary")
    )
    return rows.mapInArrow(run, "lang string, kind string, name string, n long").groupBy("lang", "kind", "name").agg(
        F.sum("n").alias("n")
    )


def _has_letter(word: bytes) -> bool:
    return any(byte >= 0x80 or chr(byte).isalpha() for byte in word)


def language_references(documents: DataFrame) -> dict[str, Reference]:
    """References of the languages with enough words, by name."""
    counts = histograms(documents)
    large = counts.where((F.col("kind") == "total") & (F.col("n") >= REFERENCE_WORDS))
    large = large.select("lang", F.col("n").alias("total"))
    order = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "name")
    top = counts.where("kind <> 'total'").withColumn("place", F.row_number().over(order))
    top = top.where(F.col("place") <= COMMON_WORDS).join(large, "lang")
    found: dict[str, list] = defaultdict(list)
    for row in top.orderBy("lang", "kind", "place").collect():
        found[row.lang].append(row)
    references = {}
    for lang, rows in found.items():
        by_class = {row.name: row.n for row in rows if row.kind == "class"}
        words = [row for row in rows if row.kind == "word"]
        common = [row.n for row in words]
        references[lang] = Reference(
            np.array([by_class.get(name, 0) for name in CLASSES], float),
            {row.name.encode(): place for place, row in enumerate(words)},
            np.array([*common, rows[0].total - sum(common)], float),
        )
    return references


def judge(raw: bytes, lang: str | None, references: dict[str, Reference]) -> tuple:
    """The values of one document, in the order of ``RESULT``."""
    words = raw.split()
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    chars = int(counts[:0x80].sum() + counts[0xC0:].sum())
    lines = [line for line in raw.split(b"\n") if line.strip()]
    repeats = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * len(words)
    class_distance = word_distance = None
    if references:
        near = [references[lang]] if lang in references else list(references.values())
        if chars >= MIN_CLASS_CHARS:
            classes = np.bincount(BYTE_CLASSES, weights=counts)[: len(CLASSES)]
            class_distance = min(one.class_distance(classes) for one in near)
        if len(words) >= MIN_COMMON_WORDS:
            common = common_form(raw)
            word_distance = min(one.word_distance(common) for one in near)
    odd_classes = class_distance is not None and class_distance > MAX_CLASS_DISTANCE
    allowance = MAX_WORD_DISTANCE + WORD_NOISE / np.sqrt(max(1, len(words)))
    odd_words = word_distance is not None and word_distance > allowance
    return (
        len(words),
        chars - int(counts[BLANKS].sum()),
        int(counts[list(SYMBOLS)].sum()),
        len(lines) - len(set(lines)),
        repeats,
        failed,
        not (failed or odd_classes or odd_words),
        class_distance,
        word_distance,
    )


RESULT = (
    ("n_words", pa.int64()),
    ("word_chars", pa.int64()),
    ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()),
    ("base_failed", pa.bool_()),
    ("kept", pa.bool_()),
    ("class_distance", pa.float64()),
    ("word_distance", pa.float64()),
)
RESULT_DDL = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, class_distance double, word_distance double"
)


def score_quality(documents: DataFrame, references: dict[str, Reference] | None = None) -> DataFrame:
    """A row of measures and the verdict ``kept`` for every document."""
    found = language_references(documents) if references is None else references

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(1).to_pylist()
            rows = [judge(text.as_py() or b"", lang, found) for lang, text in zip(langs, batch.column(2))]
            columns = list(zip(*rows)) or [()] * len(RESULT)
            arrays = [pa.array(list(values), kind) for values, (_, kind) in zip(columns, RESULT)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", *(n for n, _ in RESULT)])

    small_batches(documents.sparkSession)
    rows = documents.select(
        F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("text").cast("string").cast("binary")
    )
    return rows.mapInArrow(run, f"doc_id long, {RESULT_DDL}")


def good_documents(documents: DataFrame, references: dict[str, Reference] | None = None) -> DataFrame:
    """The documents that are kept, with all their columns, row by row."""
    found = language_references(documents) if references is None else references

    @F.pandas_udf("boolean")
    def kept(text: pd.Series, lang: pd.Series) -> pd.Series:
        return pd.Series([judge(t, name, found)[6] for t, name in zip(text, lang)], dtype=bool)

    small_batches(documents.sparkSession)
    text = F.col("text").cast("string").cast("binary")
    return documents.where(kept(F.coalesce(text, F.lit(b"")), F.col("lang").cast("string")))
