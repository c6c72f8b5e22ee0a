"""Toxicity by a support vector machine over a subsequence string kernel.

The kernel counts the subsequences of three letters that two strings share, each
weighted by a decay to the power of its span, so gaps and inserted letters cost
something but hide nothing. The strings are windows of ``WINDOW`` letters of the words
of a text. Nystroem landmarks are strings of the labelled texts; a text is described by
how near its nearest window comes to each of them, and on these vectors a linear machine
with squared hinge loss learns the labels of whole texts. The sums of its Newton steps
are added up in Spark: the driver holds a matrix of the size of the landmarks squared.

Landmarks are ranked by how unevenly strings are spread over the two labels, at whatever
place of a word; strings near one that is chosen are passed over. The ranking knows no
threshold, so small tables take the same path as large ones.

Words are lower-cased, digits and signs that look like letters read as those, and
other signs inside a word are dropped; single letters in a row are a word as well.
A text without letters, or null, is near nothing. Without both labels every text has the
share of toxic ones (0 without any). A document with two labels is toxic if one says so;
null labels and ids say nothing. Repeated rows and null ids get a row each; columns but
``doc_id``, ``text`` and ``toxic`` are unused.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import batches_of, in_fold, once, settle, small_batches

ORDER = 3
WINDOW = 9
DECAY = 0.8
SEED = 20261
# The fit reads about so many labelled documents of each label, by a hash of the id.
TRAIN_DOCUMENTS = 10_000
# Strings of so many letters may be landmarks; of those in toxic texts the most frequent
# are counted in clean ones as well.
SHORTEST, LONGEST = 3, 8
CANDIDATES = 100_000
RANKED = 3000
LANDMARKS = 160
# A string as near as this to a landmark is none; a window as far counts as no match.
NEAR = 0.85
SAME_TEXTS = 0.7
FAR = 0.6
PENALTY = 1.0
KEPT_WORDS = 500_000

LETTERS = 48
# Fixed readings of signs that stand for letters.
LOOKALIKES = str.maketrans("013457@$!", "oieastasi")
LOOSE_LETTERS = re.compile(r"(?:(?<=\s)|^)\S(?:\s\S){2,}(?=\s|$)")


@once
def _letter_codes() -> np.ndarray:
    """Code of each character: a to z 1 to 26, other letters folded above, else 0."""
    codes = np.zeros(0x110000, np.int32)
    for point in range(len(codes)):
        char = chr(LOOKALIKES.get(point, point))
        if "a" <= char <= "z":
            codes[point] = ord(char) - 96
        elif char.isalpha():
            codes[point] = 27 + point % (LETTERS - 27)
    codes[ord("\n")] = -1
    return codes


@once
def _patterns() -> tuple[np.ndarray, np.ndarray]:
    """Places of the subsequences in a window, and their weights by span."""
    places = np.array(list(combinations(range(WINDOW), ORDER)))
    return places, DECAY ** (places[:, -1] - places[:, 0] + 1.0 - ORDER)


@once
def _sizes() -> np.ndarray:
    """Norm of a string of different letters, by their number."""
    places, weights = _patterns()
    fits = places[:, -1][None, :] < np.arange(WINDOW + 1)[:, None]
    return np.sqrt((fits * weights**2).sum(axis=1))


def letters_of(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the words' letters, -1 behind each word, and where words begin and end."""
    joined = "\n".join(word.replace("\n", " ") for word in words).lower() + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = _letter_codes()[points]
    codes = codes[codes != 0]
    ends = np.flatnonzero(codes < 0)
    return codes, np.concatenate([[0], ends[:-1] + 1]), ends


def windows_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The words' windows as rows of letter codes, and the place of each one's word.

    Shorter words are filled with 0; words of too few letters have no window.
    """
    codes, starts, ends = letters_of(words)
    sizes = ends - starts
    many = np.where(sizes < ORDER, 0, np.maximum(sizes - WINDOW, 0) + 1)
    owner = np.repeat(np.arange(len(words)), many)
    first = np.repeat(starts - np.cumsum(many) + many, many) + np.arange(many.sum())
    padded = np.concatenate([codes, np.zeros(WINDOW, np.int32)])
    rows = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[first]
    inside = np.arange(WINDOW)[None, :] < (ends[owner] - first)[:, None]
    return np.where(inside, rows, 0), owner


def strings_of(words: list[str]) -> np.ndarray:
    """Distinct strings inside the words, as numbers in base ``LETTERS``."""
    codes = letters_of(words)[0].astype(np.int64)
    found, packed, whole = [], codes, codes > 0
    for size in range(2, LONGEST + 1):
        packed = packed[:-1] * LETTERS + codes[size - 1 :]
        whole = whole[:-1] & (codes[size - 1 :] > 0)
        if size >= SHORTEST:
            found.append(packed[whole])
    return np.unique(np.concatenate(found))


def as_windows(strings: np.ndarray) -> np.ndarray:
    """Strings as rows of letter codes."""
    digits = np.stack([strings // LETTERS**place % LETTERS for place in range(WINDOW - 1, -1, -1)], axis=1)
    lead = (digits > 0).argmax(axis=1)
    place = np.arange(WINDOW)[None, :] + lead[:, None]
    return np.where(place < WINDOW, np.take_along_axis(digits, np.minimum(place, WINDOW - 1), 1), 0)


def windows(word: str) -> np.ndarray:
    return windows_of([word])[0]


def subsequences(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code and weight of each subsequence of each window; weight 0 beyond its end."""
    places, weights = _patterns()
    codes = rows[:, places[:, 0]]
    for place in range(1, ORDER):
        codes = codes * LETTERS + rows[:, places[:, place]]
    return codes, np.where(rows[:, places[:, -1]] > 0, weights[None, :], 0)


def norms(codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Roots of the kernel of each window with itself: equal subsequences add up."""
    order = np.argsort(codes, axis=1, kind="stable")
    codes, weights = np.take_along_axis(codes, order, 1), np.take_along_axis(weights, order, 1)
    first = np.ones(codes.shape, bool)
    first[:, 1:] = codes[:, 1:] != codes[:, :-1]
    sums = np.add.reduceat(weights.ravel(), np.flatnonzero(first.ravel()))
    owner = np.nonzero(first)[0]
    return np.sqrt(np.bincount(owner, weights=sums**2, minlength=len(codes)))


class Landmarks:
    """Windows to which others are compared, with the subsequences they hold."""

    def __init__(self, rows: np.ndarray):
        codes, weights = subsequences(rows)
        weights = weights / norms(codes, weights)[:, None]
        owner = np.repeat(np.arange(len(rows)), codes.shape[1])
        used = weights.ravel() > 0
        order = np.argsort(codes.ravel()[used], kind="stable")
        self.codes = codes.ravel()[used][order]
        self.weights = weights.ravel()[used][order]
        self.owner = owner[used][order]
        self.count = len(rows)
        self.known = np.unique(self.codes)
        self.place = np.zeros(LETTERS**ORDER, np.int32)
        self.place[self.known] = np.arange(1, len(self.known) + 1)
        # The most that a subsequence adds to the kernel with any landmark.
        self.most = np.zeros(LETTERS**ORDER, np.float32)
        np.maximum.at(self.most, self.codes, self.weights)

    def products(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Kernel of each window with each landmark before the window's norm is taken
        out, and the window's subsequences."""
        codes, weights = subsequences(rows)
        low = np.searchsorted(self.codes, self.known, "left")
        many = np.searchsorted(self.codes, self.known, "right") - low
        place = self.place[codes]
        row, column = np.nonzero((place > 0) & (weights > 0))
        feature = place[row, column] - 1
        sizes = many[feature]
        start = np.repeat(low[feature] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        target = np.repeat(row, sizes) * self.count + self.owner[start]
        values = np.repeat(weights[row, column], sizes) * self.weights[start]
        found = np.bincount(target, weights=values, minlength=len(codes) * self.count)
        return found.reshape(len(codes), self.count), codes, weights

    def kernel(self, rows: np.ndarray) -> np.ndarray:
        """Normalised kernel of each window with each landmark."""
        result = np.zeros((len(rows), self.count), np.float32)
        for at in range(0, len(rows), 2000):
            found, codes, weights = self.products(rows[at : at + 2000])
            result[at : at + 2000] = found / norms(codes, weights)[:, None]
        return result

    def near(self, rows: np.ndarray, far: float = FAR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Window, landmark and kernel wherever it is above ``far``."""
        parts = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for at in range(0, len(rows), 2000):
            part = rows[at : at + 2000]
            # Repeated letters only add to the norm, so these are the most that can be.
            sizes = _sizes()[(part > 0).sum(axis=1)]
            codes, weights = subsequences(part)
            able = np.flatnonzero((self.most[codes] * weights).sum(axis=1) > far * sizes)
            found, codes, weights = self.products(part[able])
            high = np.flatnonzero((found > far * sizes[able][:, None]).any(axis=1))
            if len(high):
                exact = found[high] / norms(codes[high], weights[high])[:, None]
                row, mark = np.nonzero(exact > far)
                parts.append((at + able[high[row]], mark, exact[row, mark]))
        return tuple(np.concatenate(side) for side in zip(*parts))


@dataclass(frozen=True)
class Machine:
    """Landmarks with their weights, and the map of decisions to scores."""

    landmarks: np.ndarray | None
    weights: np.ndarray | None
    bias: float
    slope: float
    shift: float
    least: float = -np.inf

    def decisions(self, vectors: np.ndarray) -> np.ndarray:
        """Texts near nothing have the least decision met in training, and none has less."""
        found = np.maximum(vectors @ self.weights + self.bias, self.least)
        return np.where(vectors.any(axis=1), found, self.least)

    def scores(self, decisions: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * decisions + self.shift, -30, 30)))


def words_of(text: str) -> set[str]:
    """The distinct words of a text, and its runs of single letters as words."""
    found = set(text.split())
    for match in LOOSE_LETTERS.finditer(text):
        found.add("".join(match[0].split()))
    return found


class Nearness:
    """How near texts come to landmarks; that of words is kept, as most come again."""

    def __init__(self, landmarks: np.ndarray):
        self.landmarks = Landmarks(landmarks)
        self.count = len(landmarks)
        # Words that are near no landmark are known as such by 0.
        self.known: dict[str, int] = {}
        self.found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0))]

    def _learn(self, words: list[str]) -> None:
        rows, owner = windows_of(words)
        row, mark, value = self.landmarks.near(rows)
        word = owner[row]
        self.known.update(dict.fromkeys(words, 0))
        edges = np.flatnonzero(np.diff(word, prepend=-1, append=-1))
        for low, high in zip(edges[:-1].tolist(), edges[1:].tolist()):
            self.known[words[word[low]]] = len(self.found)
            self.found.append((mark[low:high], value[low:high]))

    def vectors(self, texts: list[str]) -> np.ndarray:
        """One row for each text: the kernel of its nearest window with each landmark."""
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
            del self.found[1:]
        bags = [words_of(text) for text in texts]
        new = list(set().union(*bags).difference(self.known))
        if new:
            self._learn(new)
        result = np.zeros((len(texts), self.count), np.float32)
        for row, bag in zip(result, bags):
            for place in set(map(self.known.__getitem__, bag)):
                mark, value = self.found[place]
                np.maximum.at(row, mark, value)
        return result


def blurred(text: str) -> str:
    """The distinct words of a text, each with a letter inside doubled or a strange one put in."""

    def hide(word: str) -> str:
        drawn = zlib.crc32(word.encode("utf-8", "replace"))
        at = 1 + drawn // 3 % max(1, len(word) - 1)
        return word[:at] + (word[at - 1], "x", "q")[drawn % 3] + word[at:]

    return " ".join(sorted(map(hide, words_of(text))))


def chosen_landmarks(strings: np.ndarray, toxic_docs: np.ndarray, clean_docs: np.ndarray, toxic: int, clean: int) -> np.ndarray:
    """Windows of the strings that are spread most unevenly, each saying something new.

    Passed over are strings near a chosen one, and parts or extensions of a chosen one
    that are in almost the same texts.
    """
    pooled = (toxic_docs + clean_docs + 0.5) / (toxic + clean + 1)
    apart = toxic_docs / toxic - clean_docs / clean
    score = apart / np.sqrt(pooled * (1 - pooled) * (1 / toxic + 1 / clean))
    # Of equal scores the longer string says more.
    order = np.lexsort((strings, -strings, -score))
    ranked = order[:RANKED]
    rows = as_windows(strings[ranked])
    likeness = Landmarks(rows).kernel(rows)
    names = ["".join(map(chr, row[row > 0])) for row in rows]
    many = toxic_docs[ranked] + clean_docs[ranked]
    free, kept = np.ones(len(rows), bool), []
    for row, name in enumerate(names):
        if not free[row] or len(kept) == LANDMARKS:
            continue
        if any((name in names[o] or names[o] in name) and min(many[row], many[o]) > SAME_TEXTS * max(many[row], many[o]) for o in kept):
            continue
        kept.append(row)
        free &= likeness[row] < NEAR
    return rows[kept]


def nystroem(landmarks: np.ndarray) -> np.ndarray:
    """The root of the inverse kernel matrix of the landmarks."""
    values, vectors = np.linalg.eigh(Landmarks(landmarks).kernel(landmarks).astype(float))
    return (vectors / np.sqrt(np.maximum(values, 1e-3 * values.max()))) @ vectors.T


def squared_hinge(rows: DataFrame, features: int, penalty: float = PENALTY) -> np.ndarray:
    """Weights (the last is the bias) of the linear machine on ``vector, toxic``.

    Each Newton step is one job: tasks add up the products of the rows inside the
    margin, and the driver solves for the sums.
    """
    weights = np.zeros(features + 1)
    ridge = penalty * np.eye(features + 1)
    ridge[-1, -1] = 1e-6
    before = np.inf
    for step in range(30):
        now = weights.copy()

        def run(batches: Iterator[pa.RecordBatch], now: np.ndarray = now, first: bool = step == 0) -> Iterator[pa.RecordBatch]:
            square, side, loss = np.zeros((len(now), len(now))), np.zeros(len(now)), 0.0
            for batch in batches:
                data = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.float32).reshape(batch.num_rows, -1)
                data = np.hstack([data, np.ones((len(data), 1))])
                signs = 2.0 * batch.column(1).to_numpy() - 1
                slack = 1 - signs * (data @ now)
                inside = slack > 0
                square += data[inside].T @ data[inside]
                side += data[inside].T @ signs[inside]
                loss += (slack[inside] ** 2).sum()
            arrays = [pa.array([part.tobytes()], pa.binary()) for part in (square, side)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array([loss])], names=["square", "side", "loss"])

        parts = rows.select("vector", "toxic").mapInArrow(run, "square binary, side binary, loss double").collect()
        square = sum(np.frombuffer(part.square) for part in parts).reshape(len(now), -1)
        side = sum(np.frombuffer(part.side) for part in parts)
        loss = sum(part.loss for part in parts) + now @ ridge @ now
        if loss > before * (1 - 1e-6):
            break
        before, best = loss, now
        weights = now + 0.9 * (np.linalg.solve(square + ridge, side) - now) if step > 4 else np.linalg.solve(square + ridge, side)
    return best


def platt(decisions: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic map from decisions to scores."""
    data = np.stack([decisions, np.ones(len(decisions))], axis=1)
    positive, total = labels.sum(), len(labels)
    target = np.where(labels == 1, (positive + 1) / (positive + 2), 1 / (total - positive + 2))
    fit = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(data @ fit, -30, 30)))
        slope = data.T @ (p - target) + 1e-3 * np.array([fit[0], 0])
        curve = (data * (p * (1 - p))[:, None]).T @ data + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        fit = fit - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return max(float(fit[0]), 1e-3), float(fit[1])


def training_rows(documents: DataFrame, labels: DataFrame, learn: Column, each: int = TRAIN_DOCUMENTS) -> DataFrame:
    """``text, toxic`` of about ``each`` labelled documents of either label."""
    rows = labels.where("doc_id is not null and toxic is not null")
    rows = rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    rows = rows.where(learn)
    sizes = {row.toxic: row["count"] for row in rows.where("toxic in (0, 1)").groupBy("toxic").count().collect()}
    draw = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1_000_000))
    share = F.lit(0)
    for label, size in sizes.items():
        share = F.when(F.col("toxic") == label, int(min(1.0, each / size) * 1_000_000)).otherwise(share)
    # About 2 * each pairs of numbers: small whatever the size of the tables.
    chosen = F.broadcast(rows.where(draw < share))
    texts = documents.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.join(chosen, "doc_id").select("text", "toxic")


def string_counts(texts: DataFrame, among: np.ndarray | None = None) -> DataFrame:
    """``string, many``: in how many texts each string is, of all or of some (sorted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [strings_of(list(words_of(text))) for text in batch.column(0).to_pylist()]
            strings, many = np.unique(np.concatenate([np.zeros(0, np.int64), *found]), return_counts=True)
            if among is not None:
                wanted = np.isin(strings, among, assume_unique=True)
                strings, many = strings[wanted], many[wanted]
            yield pa.RecordBatch.from_arrays([pa.array(strings), pa.array(many.astype(np.int64))], names=["string", "many"])

    found = texts.select("text").mapInArrow(run, "string long, many long")
    return found.groupBy("string").agg(F.sum("many").alias("many"))


def landmarks_of(rows: DataFrame, toxic: int, clean: int) -> np.ndarray:
    """Landmarks from the labelled texts; at most ``CANDIDATES`` strings reach the driver."""
    counted = string_counts(rows.where("toxic = 1")).where(F.col("many") >= min(2, toxic))
    frequent = counted.orderBy(F.desc("many"), "string").limit(CANDIDATES).toPandas().sort_values("string")
    strings, toxic_docs = frequent["string"].to_numpy(np.int64), frequent["many"].to_numpy(np.int64)
    if not len(strings):
        return np.zeros((0, WINDOW), np.int64)
    other = string_counts(rows.where("toxic <> 1"), strings).toPandas()
    clean_docs = np.zeros(len(strings))
    clean_docs[np.searchsorted(strings, other["string"].to_numpy(np.int64))] = other["many"].to_numpy()
    return chosen_landmarks(strings, toxic_docs, clean_docs, toxic, clean)


def fit(documents: DataFrame, labels: DataFrame, learn: Column, each: int = TRAIN_DOCUMENTS) -> Machine:
    """The machine from the labelled documents where ``learn`` holds for ``doc_id``."""
    with batches_of(documents.sparkSession):
        rows = settle(training_rows(documents, labels, learn, each), "toxicity-texts")
        totals = {row.toxic: row["count"] for row in rows.groupBy("toxic").count().collect()}
        toxic, clean = totals.get(1, 0), sum(many for label, many in totals.items() if label != 1)
        share = toxic / max(1, toxic + clean)
        constant = Machine(None, None, 0.0, 0.0, float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
        landmarks = landmarks_of(rows, toxic, clean) if toxic and clean else np.zeros((0, WINDOW), np.int64)
        if not len(landmarks):
            return constant
        project = nystroem(landmarks)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nearness = Nearness(landmarks)
            for batch in batches:
                texts = batch.column(0).to_pylist()
                # What hides a word is part of the training, of either label.
                for some in (texts, list(map(blurred, texts))):
                    vectors = (nearness.vectors(some) @ project).astype(np.float32)
                    packed = pa.array([row.tobytes() for row in vectors], pa.binary())
                    yield pa.RecordBatch.from_arrays([packed, batch.column(1)], names=["vector", "toxic"])

        vectors = settle(rows.mapInArrow(run, "vector binary, toxic int"), "toxicity-vectors")
        solution = squared_hinge(vectors, len(landmarks))
        raw = Machine(landmarks, project @ solution[:-1], float(solution[-1]), 1.0, 0.0)

        def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                data = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.float32).reshape(batch.num_rows, -1)
                worst = data @ solution[:-1] + solution[-1]
                yield pa.RecordBatch.from_arrays([pa.array(worst, pa.float64()), batch.column(1)], names=["decision", "toxic"])

        known = vectors.mapInArrow(decide, "decision double, toxic int").toPandas()
    slope, shift = platt(known.decision.to_numpy(), known.toxic.to_numpy())
    return replace(raw, slope=slope, shift=shift, least=float(known.decision.min()))


def score_texts(documents: DataFrame, machine: Machine) -> DataFrame:
    """``doc_id, score``, from 0 to 1, for every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearness = None if machine.landmarks is None else Nearness(machine.landmarks)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            decisions = machine.decisions(nearness.vectors(texts)) if nearness else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(machine.scores(decisions))], names=["doc_id", "score"])

    small_batches(documents.sparkSession)
    texts = documents.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")))
    return texts.mapInArrow(run, "doc_id long, score double")


def score_toxicity(documents: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0) -> DataFrame:
    """``doc_id, held_out, score, predicted``; learns where not ``held_out``."""
    held_out = in_fold(F.col("doc_id"), modulus, remainder)
    machine = fit(documents, labels, ~held_out)
    scored = score_texts(documents, machine)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
