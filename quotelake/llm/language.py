"""Languages by hyperdimensional profiles of letter n-grams.

Every letter has a random vector of +1 and -1. An n-gram's vector binds those of
its letters, each permuted by its place, by multiplication; a text bundles the
vectors of its n-grams by addition. A language's prototype bundles its training
texts, and a text is of the language whose prototype has the largest cosine.

Text is lower-cased; all that is no letter is a blank between words, and blanks
are letters of n-grams. A null text, or one without letters, is ``und`` with
score 0, as is every text if nothing was learned. Equal cosines go to the first
name. Repeated rows and null ids get a row each; a null id counts as empty text
where documents are held out. Columns but ``doc_id``, ``text``, ``lang`` are unused.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import in_fold, once, small_batches

DIMENSIONS = 1024
NGRAM = 3
SEED = 20260
UNKNOWN = "und"
# A prototype bundles about so many documents, chosen by a hash of their ids.
TRAIN_PER_LANGUAGE = 2000
# Names of fewer training documents are not learned: the driver holds a prototype each.
LEAST_DOCUMENTS = 2
# Texts are worked through in pieces, so that a long one needs no large arrays.
PIECE = 1 << 20
# Vectors of so many n-grams are kept by a worker before it starts anew.
KEPT_VECTORS = 40_000
GROUP = 64


@once
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.array([chr(code).isalpha() for code in range(0x110000)])


def _codes(text: str, before: np.ndarray) -> np.ndarray:
    """Code points after ``before``, blanks as 0 and never two in a row."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    known = _letters()
    points = np.where(known[np.minimum(points, len(known) - 1)], points, 0)
    points = np.concatenate([before, points])
    twice = np.zeros(len(points), bool)
    twice[1:] = (points[1:] == 0) & (points[:-1] == 0)
    return points[~twice]


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams, as one number each, and how often they occur."""
    lowered = text.lower()
    grams, counts, carry = [], [], np.zeros(1, np.int64)
    for at in range(0, len(lowered), PIECE):
        end = at + PIECE >= len(lowered)
        codes = _codes(lowered[at : at + PIECE] + (" " if end else ""), carry)
        windows = len(codes) - NGRAM + 1
        if windows > 0:
            packed = np.zeros(windows, np.int64)
            for place in range(NGRAM):
                packed = packed << 21 | codes[place : place + windows]
            found, many = np.unique(packed, return_counts=True)
            grams.append(found)
            counts.append(many)
            carry = codes[-(NGRAM - 1) :]
        else:
            carry = codes
    if not grams:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(grams) == 1:
        return grams[0], counts[0]
    whole, place = np.unique(np.concatenate(grams), return_inverse=True)
    return whole, np.bincount(place, weights=np.concatenate(counts)).astype(np.int64)


class Profiles:
    """Bundles texts; n-gram vectors are made when first met and kept."""

    def __init__(self, dimensions: int = DIMENSIONS):
        self.dimensions = dimensions
        self.letters: dict[int, np.ndarray] = {}
        self._restart()

    def _restart(self) -> None:
        self.known = np.zeros(0, np.int64)
        self.vectors = np.zeros((0, self.dimensions), np.float32)

    def _letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            random = np.random.default_rng([SEED, code])
            self.letters[code] = random.integers(0, 2, self.dimensions, np.int8) * 2 - 1
        return self.letters[code]

    def _bind(self, gram: int) -> np.ndarray:
        vector = np.ones(self.dimensions, np.int8)
        for place in range(NGRAM):
            code = gram >> 21 * (NGRAM - 1 - place) & 0x1FFFFF
            vector = vector * np.roll(self._letter(code), NGRAM - 1 - place)
        return vector

    def _places(self, grams: np.ndarray) -> np.ndarray:
        """Rows of the n-grams (sorted, distinct) in the table of vectors."""
        if len(self.known) > KEPT_VECTORS:
            self._restart()
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, grams), len(self.known) - 1)
            new = grams[self.known[at] != grams]
        else:
            new = grams
        if len(new):
            order = np.argsort(np.concatenate([self.known, new]), kind="stable")
            made = np.stack([self._bind(int(gram)) for gram in new]).astype(np.float32)
            self.vectors = np.concatenate([self.vectors, made])[order]
            self.known = np.concatenate([self.known, new])[order]
        return np.searchsorted(self.known, grams)

    def bundle(self, texts: list[str]) -> np.ndarray:
        """One row for each text; a text without letters has zeros."""
        rows = np.zeros((len(texts), self.dimensions))
        for at in range(0, len(texts), GROUP):
            found = [ngram_counts(text) for text in texts[at : at + GROUP]]
            grams = np.unique(np.concatenate([each for each, _ in found]))
            if not len(grams):
                continue
            counts = np.zeros((len(found), len(grams)), np.float32)
            for row, (own, many) in enumerate(found):
                # A lone blank-only n-gram says nothing.
                counts[row, np.searchsorted(grams, own)] = np.where(own > 0, many, 0)
            places = self._places(grams)
            rows[at : at + len(found)] = counts @ self.vectors[places]
        return rows


def training_share(documents: DataFrame, learn: object, per_language: int = TRAIN_PER_LANGUAGE) -> dict[str, float]:
    """Share of each language's training documents that a prototype bundles."""
    rows = documents.where(learn & F.col("lang").isNotNull())
    sizes = rows.groupBy(F.col("lang").cast("string").alias("lang")).count()
    return {row.lang: min(1.0, per_language / row["count"]) for row in sizes.where(F.col("count") >= LEAST_DOCUMENTS).collect()}


def prototypes(documents: DataFrame, learn: object, per_language: int = TRAIN_PER_LANGUAGE) -> dict[str, np.ndarray]:
    """Unit prototype vectors by language, from the documents where ``learn`` holds."""
    shares = training_share(documents, learn, per_language)
    if not shares:
        return {}
    pairs = [F.lit(x) for name, share in shares.items() for x in (name, int(share * 1_000_000))]
    lang = F.col("lang").cast("string")
    # By the text as well: ids may be null or equal.
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.col("text").cast("string"), F.lit(SEED)), F.lit(1_000_000))
    chosen = documents.where(learn & (draw < F.create_map(*pairs)[lang]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles, sums = Profiles(), {}
        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), object)
            rows = profiles.bundle(batch.column(1).to_pylist()).astype(np.int64)
            for name in set(names):
                sums[name] = sums.get(name, 0) + rows[names == name].sum(axis=0)
        for name, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(total)), pa.array(np.arange(len(total))), pa.array(total)],
                names=["lang", "place", "value"],
            )

    small_batches(documents.sparkSession)
    texts = chosen.select(lang, F.coalesce(F.col("text").cast("string"), F.lit("")))
    # Whole numbers: the sum is the same in any order.
    sums = texts.mapInArrow(run, "lang string, place long, value long").groupBy("lang", "place").agg(F.sum("value").alias("value"))
    found: dict[str, np.ndarray] = {}
    for row in sums.orderBy("lang", "place").toLocalIterator():
        found.setdefault(row.lang, np.zeros(DIMENSIONS))[row.place] = row.value
    return {name: vector / np.linalg.norm(vector) for name, vector in sorted(found.items()) if vector.any()}


def identify(documents: DataFrame, models: dict[str, np.ndarray]) -> DataFrame:
    """``doc_id, lang_pred, score``: the closest prototype and its cosine, 0 at least."""
    names = sorted(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = Profiles()
        matrix = np.stack([models[name] for name in names]).T if names else np.zeros((DIMENSIONS, 0))
        for batch in batches:
            rows = profiles.bundle(batch.column(1).to_pylist())
            sizes = np.linalg.norm(rows, axis=1)
            known = sizes > 0 if names else np.zeros(len(rows), bool)
            cosines = rows @ matrix / np.where(sizes > 0, sizes, 1)[:, None]
            best = cosines.argmax(axis=1) if names else np.zeros(len(rows), int)
            score = np.where(known, np.clip(cosines.max(axis=1, initial=0), 0, 1), 0.0)
            predicted = [names[at] if any_ else UNKNOWN for at, any_ in zip(best, known)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(predicted, pa.string()), pa.array(score, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    small_batches(documents.sparkSession)
    texts = documents.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")))
    return texts.mapInArrow(run, "doc_id long, lang_pred string, score double")


def predict_languages(documents: DataFrame, modulus: int = 4, remainder: int = 2) -> DataFrame:
    """Learns where the crc32 of the id leaves another remainder, predicts all."""
    held_out = in_fold(F.col("doc_id"), modulus, remainder)
    models = prototypes(documents, ~held_out)
    return identify(documents, models).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
