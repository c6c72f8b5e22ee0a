"""Packing by lexical retrieval: documents share a training window with their like.

Documents are dealt into shards by a lexical signature, the least hash of their
long words, so that like documents tend to meet. Each shard has a BM25 inverted
index. A window starts with a seed document, all of whose words are the query; the
unused neighbours fill the window in the order of their scores, and the one that does
not fit any more is cut. What is left of it seeds the next window.

Words of an eighth of a shard's documents or more have a dense row of their scores
instead of postings: adding rows costs less than adding up long postings.

A shard holds at most ``SHARD_BYTES`` of text (or one longer document), whatever
share of the rows has one signature: hot signatures are spread by a hash of the id,
and a task works through its rows shard by shard with one window open across them.
The rest of a task's last window is cut at powers of two, which need no padding.

A null or empty text is the end token alone. Repeated rows and null ids are packed
like any other row. Columns but ``doc_id`` and ``text`` are not looked at. An empty
table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quotelake.llm.common import give_back, settle, small_batches

WINDOW = 4096
END_TOKEN = 2
SHARD_BYTES = 12_000_000
# One task's share of the text; the tasks grow in number with the table.
TASK_BYTES = 128_000_000
# What a row costs besides its text: very many empty texts are a load as well.
ROW_BYTES = 256
# Neighbours that are put in order at first; the others only if a window needs more.
BEST = 16
# A word in one document of so many, or in more, has a dense row.
DENSE = 8
K1, B = 1.2, 0.75
LONG_WORD = 10
# One document in so many tells how the signatures are spread.
SIGNATURE_SAMPLE = 32
KEPT_WORDS = 1_500_000
# Words are found in pieces of so many bytes: what a piece needs beside them is 100 times as much.
CHUNK = 1 << 18

# Multipliers of two polynomial hashes of words, modulo 2**64.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class Words(NamedTuple):
    """Words of a text buffer: places in it and two hashes."""

    start: np.ndarray
    end: np.ndarray
    one: np.ndarray
    two: np.ndarray


def _byte_kinds() -> np.ndarray:
    """Kind of each byte: 0 other, 1 blank, 2 small letter, 3 digit, 4 sign but no quote."""
    kinds = np.zeros(256, np.uint8)
    kinds[[9, 10, 11, 12, 13, 32]] = 1
    kinds[ord("a") : ord("z") + 1] = 2
    kinds[ord("0") : ord("9") + 1] = 3
    kinds[[byte for byte in range(33, 127) if not chr(byte).isalnum() and chr(byte) != "'"]] = 4
    kinds[ord("A") : ord("Z") + 1] = 0
    return kinds


KINDS = _byte_kinds()
_BLANK = KINDS == 1
# Between these kinds, and between two digits, the tokenizer cuts whatever stands
# around; after a single quote it may not, as in the ends of short forms.
_CUTS = np.zeros((5, 5), bool)
_CUTS[2:, 2:] = ~np.eye(3, dtype=bool)
_CUTS[3, 3] = True


def lowered(text: bytes) -> bytes:
    """Small letters, one by one as the tokenizer has them: no final sigma."""
    return text.decode("utf-8", "replace").replace("\u03a3", "\u03c3").lower().encode("utf-8")


def find_words(text: np.ndarray) -> Words:
    """Words between blanks, cut where the tokenizer is sure to cut, too.

    So a word with signs at its end is no other word. ``text`` is ``lowered``.
    """
    kinds = KINDS[text]
    blank = kinds == 1
    cut = np.ones(len(text) + 1, bool)
    cut[1:-1] = _CUTS[kinds[:-1], kinds[1:]] | blank[:-1] | blank[1:]
    # Letters of two bytes, from a with grave to z with caron, end like a to z.
    at = np.flatnonzero((kinds[2:] == 4) & (text[1:-1] >= 0x80)) + 2
    lead, last = text[at - 2], text[at - 1]
    letter = ((lead == 0xC3) & (last != 0x97) & (last != 0xB7)) | (lead == 0xC4) | ((lead == 0xC5) & (last < 0xBF))
    cut[at[letter]] = True
    start = np.flatnonzero(cut[:-1] & ~blank)
    end = np.flatnonzero(cut[1:] & ~blank) + 1
    hashes = []
    for multiplier in MULTIPLIERS:
        powers = _powers(multiplier, len(text))
        sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * powers, out=sums[1:])
        # The inverse power moves every word to the same place.
        inverse = pow(multiplier, -1, 1 << 64)
        hashes.append((sums[end] - sums[start]) * _powers(inverse, len(text))[start])
    return Words(start, end, *hashes)


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, size: int) -> np.ndarray:
    known = _POWERS.get(base, np.ones(1, np.uint64))
    while len(known) < size:
        known = np.concatenate([known, known * np.uint64(pow(base, len(known), 1 << 64))])
    _POWERS[base] = known
    return known[:size]


class WordTokens:
    """Tokens of words: those met before come from a table, sorted by hash."""

    def __init__(self, path: str):
        self.path = path
        self.tokenizer = Tokenizer.from_file(path)
        # Names of special tokens inside a text are text.
        self.tokenizer.encode_special_tokens = True
        self._restart()

    def _restart(self) -> None:
        self.one, self.two = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.low, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint16)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First place and number of each word's tokens, and the tokens.

        Words of letters are one piece each and go through as one text, which is
        fast: the tokens tell their piece.
        """
        low, size = np.zeros((2, len(words)), np.int64)
        plain = np.array([word.isalpha() for word in words], bool)
        parts = np.array_split(np.flatnonzero(plain), 1 + plain.sum() // 5000)
        odd = np.flatnonzero(~plain)
        odd = np.split(odd, len(odd)) if len(odd) else []
        flat, held = [], 0
        while parts or odd:
            part = parts.pop() if parts else odd.pop()
            if not len(part):
                continue
            encoding = self.tokenizer.encode(" ".join(words[place] for place in part), add_special_tokens=False)
            piece = np.array(encoding.word_ids, np.int64)
            if len(part) == 1:
                many = np.array([len(piece)])
            elif piece.max(initial=-1) != len(part) - 1:
                odd.extend(np.split(part, len(part)))  # some word is more than one piece
                continue
            else:
                many = np.bincount(piece, minlength=len(part))
            size[part], low[part] = many, held + np.cumsum(many) - many
            flat.append(np.array(encoding.ids, np.uint16))
            held += len(piece)
        return low, size, np.concatenate([np.zeros(0, np.uint16), *flat])

    def look_up(self, text: np.ndarray, words: Words, first: np.ndarray) -> np.ndarray:
        """Rows of the table for the distinct words at ``first``, in order of their hash."""
        if len(self.one) > KEPT_WORDS:
            self._restart()
        one, two = words.one[first], words.two[first]
        at = np.searchsorted(self.one, one)
        inside = np.minimum(at, max(0, len(self.one) - 1))
        new = np.ones(len(one), bool)
        if len(self.one):
            new = self.one[inside] != one
            if (self.two[inside][~new] != two[~new]).any():
                self._restart()
                return self.look_up(text, words, first)
        if new.any():
            raw = memoryview(text)
            spans = zip(words.start[first][new].tolist(), words.end[first][new].tolist())
            lows, sizes, flat = self._encode([str(raw[a:b], "utf-8", "replace") for a, b in spans])
            lows += len(self.flat)
            self.flat = np.concatenate([self.flat, flat])
            order = np.argsort(np.concatenate([self.one, one[new]]), kind="stable")
            self.one = np.concatenate([self.one, one[new]])[order]
            self.two = np.concatenate([self.two, two[new]])[order]
            self.low = np.concatenate([self.low, lows])[order]
            self.size = np.concatenate([self.size, sizes])[order]
        return np.searchsorted(self.one, one)


def _told_apart(buffer: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """First place and number of each word, by its bytes: for words that share a hash."""
    raw, names = buffer.tobytes(), {}
    spans = zip(words.start.tolist(), words.end.tolist())
    term = np.array([names.setdefault(raw[a:b], len(names)) for a, b in spans], np.int64)
    return np.unique(term, return_index=True)[1], term


def _pieces(buffer: np.ndarray) -> Iterator[tuple[int, Words]]:
    """Words of a buffer in pieces that end between words, to need no large arrays; where each begins."""
    at = 0
    while at < len(buffer):
        end = min(len(buffer), at + CHUNK)
        while end < len(buffer) and not _BLANK[buffer[end - 1]]:
            gap = np.flatnonzero(_BLANK[buffer[end : end + CHUNK]])
            end = end + int(gap[0]) + 1 if len(gap) else min(len(buffer), end + CHUNK)
        yield at, find_words(buffer[at:end])
        at = end


def _distinct(words: Words) -> tuple[Words, np.ndarray, bool]:
    """The distinct words by hash, the number of each word, and whether two words share a hash."""
    _, first, term = np.unique(words.one, return_index=True, return_inverse=True)
    clash = bool((words.two != words.two[first][term]).any())
    return Words(*(column[first] for column in words)), term.astype(np.int32), clash


class Shard:
    """Tokens of some documents, and the inverted index of their words.

    Of every word only its number is held, and the hashes of the distinct ones.
    """

    def __init__(self, texts: list[bytes], tokens: WordTokens):
        self.count = len(texts)
        texts = [lowered(text) for text in texts]
        buffer = np.frombuffer(b"\n".join(texts), np.uint8)
        begins = np.cumsum([0, *(len(text) + 1 for text in texts)])
        del texts
        found, numbers, clash = [], [], False
        self.word_of_doc = np.zeros(self.count + 1, np.int64)
        for at, words in _pieces(buffer):
            self.word_of_doc += np.searchsorted(words.start + at, begins)
            own, term, shared = _distinct(words)
            found.append(own._replace(start=own.start + at, end=own.end + at))
            numbers.append(term)
            clash = clash or shared
        kinds = (np.int64, np.int64, np.uint64, np.uint64)
        every = Words(*(np.concatenate([np.zeros(0, kind), *columns]) for kind, columns in zip(kinds, zip(*found) if found else [()] * 4)))
        words, place, shared = _distinct(every)
        if clash or shared:
            spans = [np.stack([piece.start + at, piece.end + at]) for at, piece in _pieces(buffer)]
            start, end = np.concatenate(spans, axis=1)
            first, self.term = _told_apart(buffer, Words(start, end, start, end))
            self.term = self.term.astype(np.int32)
            names = np.arange(len(first), dtype=np.uint64)
            words = Words(start[first], end[first], names, names)
            tokens = WordTokens(tokens.path)
            del spans, start, end, first
        else:
            # Numbers in a piece become numbers in the shard.
            low = 0
            for number, own in enumerate(found):
                numbers[number] = place[low : low + len(own.one)][numbers[number]]
                low += len(own.one)
            self.term = np.concatenate([np.zeros(0, np.int32), *numbers])
        rows = tokens.look_up(buffer, words, np.arange(len(words.one)))
        self.word_low, self.word_size, self.flat = tokens.low[rows], tokens.size[rows], tokens.flat
        # Before the index, which needs room of its own.
        del buffer, words, found, numbers, every, place, rows
        before = np.zeros(len(self.term) + 1, np.int64)
        np.cumsum(self.word_size[self.term], out=before[1:])
        self.sizes = np.diff(before[self.word_of_doc]) + 1
        del before
        give_back()
        self._index(len(self.word_size))
        give_back()

    def _index(self, terms: int) -> None:
        length = np.diff(self.word_of_doc)
        pairs = self.term.astype(np.int64)
        pairs *= self.count
        pairs += np.repeat(np.arange(self.count, dtype=np.int32), length)
        pairs.sort()
        new = np.ones(len(pairs), bool)
        new[1:] = pairs[1:] != pairs[:-1]
        first = np.flatnonzero(new)
        counts = np.diff(first, append=len(pairs)).astype(np.int32)
        term = pairs[first]
        del pairs, new, first
        self.doc = np.empty(len(term), np.int32)
        np.remainder(term, max(1, self.count), out=self.doc, casting="unsafe")
        term //= max(1, self.count)
        self.posting = np.searchsorted(term, np.arange(terms + 1))
        self.among = np.diff(self.posting)
        self.idf = np.log(1 + (self.count - self.among + 0.5) / (self.among + 0.5))
        norm = K1 * (1 - B + B * length / max(1.0, length.mean())) if self.count else length
        self.impact = np.empty(len(term), np.float32)
        for at in range(0, len(term), CHUNK):
            part = slice(at, at + CHUNK)
            many = counts[part]
            self.impact[part] = self.idf[term[part]] * many * (K1 + 1) / (many + norm[self.doc[part]])
        del term, counts
        often = np.flatnonzero(self.among * DENSE >= max(2, self.count))
        self.row = np.full(terms, -1, np.int32)
        self.row[often] = np.arange(len(often))
        self.dense = np.zeros((len(often), self.count), np.float32)
        for row, word in enumerate(often.tolist()):
            span = slice(self.posting[word], self.posting[word + 1])
            self.dense[row, self.doc[span]] = self.impact[span]

    def tokens(self, doc: int) -> np.ndarray:
        """Ids of one document, with the end token."""
        term = self.term[self.word_of_doc[doc] : self.word_of_doc[doc + 1]]
        sizes = self.word_size[term]
        at = np.repeat(self.word_low[term] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        return np.append(self.flat[at], END_TOKEN).astype("<u4")

    def query(self, doc: int) -> np.ndarray:
        """Words of a document that others have as well: one of its own finds nothing."""
        own = np.sort(self.term[self.word_of_doc[doc] : self.word_of_doc[doc + 1]])
        new = np.ones(len(own), bool)
        new[1:] = own[1:] != own[:-1]
        return own[new & (self.among[own] > 1)]

    def scores(self, query: np.ndarray) -> np.ndarray:
        """BM25 score of each document for the words."""
        rows = self.row[query]
        scores = np.add.reduce(self.dense[rows[rows >= 0]], axis=0, dtype=np.float64)
        low = self.posting[query[rows < 0]]
        size = self.among[query[rows < 0]]
        at = np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())
        return scores + np.bincount(self.doc[at], weights=self.impact[at], minlength=self.count)

    def neighbours(self, query: np.ndarray, unused: np.ndarray) -> Iterator[int]:
        """Unused documents with a word of the query, by score, ties by place.

        Put in order as far as they are asked for; one that is used by then is left out.
        """
        scores = np.where(unused, self.scores(query), 0.0)
        least = np.partition(scores, -BEST)[-BEST] if self.count > BEST else 0.0
        for wanted in ((scores >= least) & (scores > 0), (scores < least) & (scores > 0)):
            found = np.flatnonzero(wanted & unused)
            found = found[np.argsort(-scores[found], kind="stable")]
            yield from (int(doc) for doc in found if unused[doc])


class Piece(NamedTuple):
    doc_id: int | None
    start: int
    length: int
    ids_crc32: int
    doc_tokens: int
    sequence_id: int
    offset: int


class Packer:
    """Fills windows with the documents of one shard after the other."""

    def __init__(self, base: int):
        self.next_id = base
        self.filled = 0
        self.open: list[tuple] = []

    def _close(self) -> Iterator[Piece]:
        for doc_id, start, ids, total, offset in self.open:
            yield Piece(doc_id, start, len(ids), zlib.crc32(ids.tobytes()), total, self.next_id, offset)
        self.open, self.filled = [], 0
        self.next_id += 1

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[Piece]:
        """A document, cut where windows are full."""
        at = 0
        while at < len(ids):
            part = ids[at : at + WINDOW - self.filled]
            self.open.append((doc_id, at, part, len(ids), self.filled))
            self.filled += len(part)
            at += len(part)
            if self.filled == WINDOW:
                yield from self._close()

    def pack(self, shard: Shard, ids: list[int | None]) -> Iterator[Piece]:
        """All documents of a shard; the last window stays open."""
        unused = np.ones(shard.count, bool)
        first, seed = 0, None
        asked, found = None, iter(())
        while True:
            if seed is None:
                while first < shard.count and not unused[first]:
                    first += 1
                if first == shard.count:
                    return
                seed, unused[first] = first, False
                yield from self.add(ids[seed], shard.tokens(seed))
            # A window without its seed's rest needs another seed.
            room = WINDOW - self.filled
            if room == WINDOW:
                seed = None
                continue
            query = shard.query(seed)
            # Seeds of the same words, such as copies, have the same neighbours: go on with them.
            if asked is None or not np.array_equal(query, asked):
                asked, found = query, shard.neighbours(query, unused)
            seed = None
            for doc in found:
                size = int(shard.sizes[doc])
                unused[doc] = False
                yield from self.add(ids[doc], shard.tokens(doc))
                if size >= room:
                    # It closes the window, and its rest is the seed of the next.
                    seed = doc if size > room else None
                    break
                room -= size

    def finish(self) -> Iterator[Piece]:
        """The open window, as sequences of powers of two."""
        rest, self.open, left = self.open, [], self.filled
        self.filled = 0
        size = WINDOW
        for doc_id, start, part, total, _ in rest:
            at = 0
            while at < len(part):
                while size > left:
                    size //= 2
                taken = part[at : at + size - self.filled]
                self.open.append((doc_id, start + at, taken, total, self.filled))
                self.filled += len(taken)
                at += len(taken)
                if self.filled == size:
                    left -= size
                    yield from self._close()


def signature(text: Column) -> Column:
    """Least hash of the long words; of the whole text if it has none."""
    words = F.regexp_extract_all(text, F.lit(rf"(\S{{{LONG_WORD},}})"))
    return F.coalesce(F.array_min(F.transform(words, lambda word: F.xxhash64(word))), F.xxhash64(text))


def deal_out(documents: DataFrame) -> DataFrame:
    """``doc_id, text`` (binary) dealt into tasks of like documents, like size."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # Null and equal ids tell no rows apart: their places in the table do.
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.monotonically_increasing_id().alias("row"))
    draw = F.pmod(F.xxhash64("doc_id", "row", F.lit(7)), F.lit(SIGNATURE_SAMPLE))
    cost = F.octet_length("text") + ROW_BYTES
    sample = rows.where(draw == 0).select(signature(F.col("text")).alias("sign"), cost.alias("bytes"))
    sizes = settle(sample.groupBy("sign").agg(F.sum("bytes").alias("bytes")), "packing-signatures")
    total = (sizes.agg(F.sum("bytes")).first()[0] or 0) * SIGNATURE_SAMPLE
    tasks = max(1, rows.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    # A signature with a quarter of a task's bytes is spread: at most four for each task.
    parts = F.ceil(F.col("bytes") * (4 * SIGNATURE_SAMPLE / TASK_BYTES)).alias("parts")
    hot = F.broadcast(sizes.select("sign", parts).where("parts > 1"))
    signed = rows.withColumn("sign", signature(F.col("text"))).join(hot, "sign", "left")
    spread = F.pmod(F.xxhash64("doc_id", "row"), F.coalesce("parts", F.lit(1)))
    dealt = signed.withColumn("spread", spread).repartition(tasks, "sign", "spread")
    return dealt.sortWithinPartitions("sign", "doc_id", "row").select("doc_id", F.col("text").cast("binary").alias("text"))


def pack_documents(documents: DataFrame, tokenizer_path: str, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """A row for each piece of a document, with its place in a sequence."""
    kinds = (pa.int64(),) * len(Piece._fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = WordTokens(tokenizer_path)
        packer = Packer(TaskContext.get().partitionId() << 40)

        def table(pieces: list[Piece]) -> pa.RecordBatch:
            columns = list(zip(*pieces)) or [()] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=list(Piece._fields))

        ids: list[int | None] = []
        texts: list[bytes] = []
        held = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc_id)
                texts.append(text.as_py())
                held += len(texts[-1]) + ROW_BYTES
                if held >= shard_bytes:
                    yield table(list(packer.pack(Shard(texts, tokens), ids)))
                    ids, texts, held = [], [], 0
                    give_back()
        last = list(packer.pack(Shard(texts, tokens), ids)) if texts else []
        yield table(last + list(packer.finish()))
        del tokens, packer, texts, last
        give_back()

    small_batches(documents.sparkSession)
    return deal_out(documents).mapInArrow(run, ", ".join(f"{name} long" for name in Piece._fields))
