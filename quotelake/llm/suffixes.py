"""Exact removal of repeated byte strings by a distributed suffix merge sort.

Every byte is removed that a string of ``length`` bytes covers which also starts
earlier: in a document with a smaller id, or before in the same one.

Not every suffix is sorted. Of the ``KMER``-byte pieces of each such string the one
with the least hash is its anchor, wherever the string stands; anchors whose piece
is met only once have no earlier copy. What is left is the suffixes at anchors that
share their piece, with the bytes before. A task sorts those of its documents to a
run; equal ones but the first are repeats already and go no further. Runs are cut in
ranges, front-coded (each suffix after its common prefix with the last) and
exchanged. Each range is merged with a loser tree that compares two suffixes only
behind the prefix that both are known to share with the last one out.

Common prefixes of neighbours give the classes of equal suffixes at every depth;
with those of the bytes before the anchors they give the classes of equal strings,
and all but the earliest of a class repeat it. A piece that very many anchors share
is not merged: its strings are dealt out by their hashes, the first of a task each.

A null text is empty; a text below ``length`` bytes repeats nothing. Null ids come
before all others. Rows with one id are versions of one document: between them a
string starts earlier if its place is smaller, so repeated rows keep the same.
Columns but ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotelake.llm.common import settle, small_batches

LENGTH = 100
KMER = 32
# Anchors of one piece beyond which its strings are dealt out by hash.
HOT_ANCHORS = 200_000
RUN_ROWS = 50_000
TEXTS_PER_BATCH = 128
RANGE_ROWS = 60_000
# Texts are worked through in segments, so that a long one needs no large arrays.
SEGMENT = 1 << 18
FIRST_ID = -(1 << 63)

_STEP = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
_HEAD = 8


def kmer_hashes(data: np.ndarray, kmer: int = KMER) -> np.ndarray:
    """Mixed polynomial hash of the ``kmer`` bytes (a power of two) at each place."""
    value = data.astype(np.uint64) + np.uint64(1)
    size, step = 1, _STEP
    while size < kmer:
        value = value[:-size] * np.uint64(step) + value[size:]
        size, step = size * 2, step * step % (1 << 64)
    value ^= value >> np.uint64(32)
    value *= _MIX
    value ^= value >> np.uint64(29)
    return value | np.uint64(1)


def spread(pieces: np.ndarray) -> np.ndarray:
    """Another number for each piece: as least ones of many, their hashes are small."""
    mixed = pieces * _MIX
    mixed ^= mixed >> np.uint64(32)
    return mixed * np.uint64(_STEP)


def _sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """Least or greatest of each ``width`` values in a row."""
    size = 1
    while size * 2 <= width:
        values = pick(values[:-size], values[size:])
        size *= 2
    return pick(values[: len(values) - width + size], values[width - size :]) if width > size else values


def anchors(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, kmer: int = KMER) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors in segments that end at ``ends``.

    An anchor has the least hash of the pieces of some string of ``length`` bytes
    inside a segment; equal ones are all anchors, so only content decides.
    """
    width = length - kmer + 1
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = kmer_hashes(data, kmer)
    least = _sliding(hashes, width, np.minimum)
    starts = np.concatenate([[0], ends[:-1]])
    for start, end in zip(starts.tolist(), ends.tolist()):
        # Strings across the end of a segment choose no anchors.
        least[max(start, end - length + 1) : end] = 0
    around = np.zeros(len(hashes) + width - 1, np.uint64)
    around[width - 1 : width - 1 + len(least)] = least
    place = np.flatnonzero(_sliding(around, width, np.maximum) == hashes)
    return place, hashes[place]


class _Segments:
    """Gathers texts and finds their anchors in arrays of like size."""

    def __init__(self, length: int, kmer: int):
        self.length, self.kmer = length, kmer
        self.parts: list[tuple[int, int, bytes]] = []
        self.held = 0

    def add(self, row: int, text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for at in range(0, max(1, len(text) - self.length + 1), SEGMENT):
            part = text[at : at + SEGMENT + self.length - 1]
            if len(part) >= self.length:
                self.parts.append((row, at, part))
                self.held += len(part)
            if self.held >= SEGMENT:
                yield self.flush()

    def flush(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, places and hashes of what is held."""
        data = np.frombuffer(b"".join(part for _, _, part in self.parts), np.uint8)
        ends = np.cumsum([len(part) for _, _, part in self.parts]).astype(np.int64)
        place, hashes = anchors(data, ends, self.length, self.kmer)
        owner = np.searchsorted(ends, place, "right")
        rows = np.array([row for row, _, _ in self.parts], np.int64)
        base = np.array([at for _, at, _ in self.parts], np.int64) - np.concatenate([[0], ends])[:-1].astype(np.int64)
        self.parts, self.held = [], 0
        if not len(place):
            return np.zeros(0, np.int64), place, hashes
        return rows[owner], place + base[owner], hashes


def find_anchors(texts: DataFrame, length: int = LENGTH, kmer: int = KMER) -> DataFrame:
    """``piece, id, version, place`` of the anchors of ``id, version, raw``, and for
    the exchange by piece ``many, lead, salt``.

    The anchors of one batch with one piece know of each other. The first leads:
    it alone goes to the task that counts the piece, with their number ``many``;
    the salt deals out the others, however many share a piece.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            versions = batch.column(1).to_numpy()
            segments = _Segments(length, kmer)
            found = [part for row, text in enumerate(batch.column(2)) for part in segments.add(row, text.as_py())]
            found.append(segments.flush())
            rows, place, hashes = (np.concatenate(parts) for parts in zip(*found))
            _, first, group, many = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
            salt = np.arange(1, len(rows) + 1, dtype=np.int32)
            salt[first] = 0
            columns = [hashes.view(np.int64), ids[rows], versions[rows], place, many[group], salt == 0, salt]
            names = ["piece", "id", "version", "place", "many", "lead", "salt"]
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in columns], names=names)

    small_batches(texts.sparkSession, TEXTS_PER_BATCH)
    return texts.mapInArrow(run, "piece long, id long, version long, place long, many long, lead boolean, salt int")


def shared_anchors(texts: DataFrame, length: int, kmer: int, hot: int) -> DataFrame:
    """``piece, id, version, place, hot`` of the anchors whose piece is met again."""
    met = F.sum("many").over(Window.partitionBy("piece", "salt"))
    found = find_anchors(texts, length, kmer).withColumn("met", met).where("met > 1")
    found = settle(found.select("piece", "id", "version", "place", "lead", "met"), "suffix-anchors")
    crowded = found.where(F.col("lead") & (F.col("met") > hot)).select("piece").distinct()
    shared = found.select("piece", "id", "version", "place")
    if crowded.isEmpty():
        return shared.withColumn("hot", F.lit(False))
    return shared.join(crowded.withColumn("hot", F.lit(True)), "piece", "left").fillna(False, ["hot"])


class Context(NamedTuple):
    """Suffixes at anchors: sort key, and where each stands.

    A key is the piece's hash, ``length`` bytes from the anchor on, those before it
    from the nearest on, filled with 0, and the numbers of both that are text.
    """

    keys: np.ndarray
    id: np.ndarray
    version: np.ndarray
    place: np.ndarray

    def take(self, at: np.ndarray) -> Context:
        return Context(*(column[at] for column in self))


def context_keys(text: bytes, place: np.ndarray, pieces: np.ndarray, length: int, kmer: int) -> np.ndarray:
    """One row of bytes for each anchor of a text."""
    before = length - kmer
    padded = np.zeros(len(text) + before + length, np.uint8)
    padded[before : before + len(text)] = np.frombuffer(text, np.uint8)
    right = np.minimum(len(text) - place, length).astype(np.uint8)
    left = np.minimum(place, before).astype(np.uint8)
    around = np.lib.stride_tricks.sliding_window_view(padded, before + length)[place]
    head = pieces.astype(">u8").view(np.uint8).reshape(-1, _HEAD)
    return np.concatenate([head, around[:, before:], around[:, :before][:, ::-1], right[:, None], left[:, None]], axis=1)


def sort_run(rows: Context) -> tuple[Context, np.ndarray, np.ndarray]:
    """Rows in order, common prefixes with the row before, and which repeat it whole."""
    first = np.lexsort((rows.place, rows.id))
    keys = np.ascontiguousarray(rows.keys[first])
    order = np.argsort(keys.view(f"S{keys.shape[1]}").ravel(), kind="stable")
    rows = rows.take(first[order])
    prefix = np.zeros(len(order), np.int64)
    differ = rows.keys[1:] != rows.keys[:-1]
    same = ~differ.any(axis=1)
    prefix[1:] = np.where(same, keys.shape[1], differ.argmax(axis=1))
    return rows, prefix, np.concatenate([[False], same])


def covered(rows: Context, least: np.ndarray, most: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """id, version, start, end of the bytes that strings from ``most`` to ``least``
    bytes before the anchors cover."""
    return rows.id, rows.version, rows.place - most, rows.place - least + length


def repeats_in_run(rows: Context, prefix: np.ndarray, same: np.ndarray, length: int) -> tuple[Context, np.ndarray, tuple]:
    """The run without whole repeats, its prefixes, and what the repeats cover.

    A row that equals the one before repeats every string around its anchor, unless
    it is a version of the same document at the same place.
    """
    group = np.cumsum(~same) - 1
    head = np.flatnonzero(~same)[group]
    later = same & ((rows.id != rows.id[head]) | (rows.place != rows.place[head]))
    # Versions of the first row stay, as it is no repeat of theirs.
    stay = ~later
    right, left = (rows.keys[later][:, column].astype(np.int64) for column in (-2, -1))
    least, most = np.maximum(0, length - right), left
    some = least <= most
    repeats = rows.take(later)
    spans = tuple(column[some] for column in covered(repeats, least, most, length))
    # Dropped rows equal the row before, so the prefixes of those that stay hold.
    return rows.take(stay), prefix[stay], spans


def front_coded(rows: Context, prefix: np.ndarray) -> bytes:
    """Rows of one range as a compressed block; the first has no prefix."""
    prefix = prefix.copy()
    prefix[0] = 0
    width = rows.keys.shape[1]
    tails = rows.keys[np.arange(width)[None, :] >= prefix[:, None]].tobytes()
    offsets = np.concatenate([[0], np.cumsum(width - prefix)]).astype(np.int32)
    tail = pa.Array.from_buffers(pa.binary(), len(prefix), [None, pa.py_buffer(offsets), pa.py_buffer(tails)])
    columns = [pa.array(prefix.astype(np.uint8)), tail, pa.array(rows.id), pa.array(rows.version), pa.array(rows.place)]
    return _block(columns, ["prefix", "tail", "id", "version", "place"])


def _block(columns: list[pa.Array], names: list[str]) -> bytes:
    batch = pa.RecordBatch.from_arrays(columns, names=names)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unblock(payload: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(payload).read_next_batch()


def merge_runs(runs: list[tuple[list[int], list[bytes]]]) -> tuple[list[tuple[int, int]], list[bytes], list[int]]:
    """Merges front-coded runs: (run, row) in order, their keys, and common prefixes.

    A loser tree whose players know how many bytes they share with the last key that
    went out. Of two players the one that shares more is smaller; only if both share
    as much are their bytes compared, from there on.
    """
    count = len(runs)
    width = 1
    while width < count:
        width *= 2
    key: list[bytes | None] = [tails[0] if tails else None for _, tails in runs] + [None] * (width - count)
    shared = [0] * width
    row = [0] * width
    losers = [0] * width

    def play(one: int, two: int) -> tuple[int, int]:
        """Winner and loser; the loser learns what it shares with the winner."""
        a, b = key[one], key[two]
        if a is None or b is None:
            return (two, one) if a is None else (one, two)
        at = shared[one]
        if at != shared[two]:
            return (one, two) if at > shared[two] else (two, one)
        if a[at:] == b[at:]:
            one, two = min(one, two), max(one, two)
            shared[two] = len(a)
            return one, two
        while a[at : at + 8] == b[at : at + 8]:
            at += 8
        while a[at] == b[at]:
            at += 1
        one, two = (one, two) if a[at] < b[at] else (two, one)
        shared[two] = at
        return one, two

    winners = list(range(width))
    level = width
    while level > 1:
        level //= 2
        played = [play(winners[2 * at], winners[2 * at + 1]) for at in range(level)]
        losers[level : 2 * level] = [loser for _, loser in played]
        winners = [winner for winner, _ in played]
    best = winners[0]
    order, keys, prefixes = [], [], []
    while (out := key[best]) is not None:
        order.append((best, row[best]))
        keys.append(out)
        prefixes.append(shared[best])
        prefix, tails = runs[best]
        row[best] += 1
        if row[best] < len(tails):
            shared[best] = prefix[row[best]]
            key[best] = out[: shared[best]] + tails[row[best]]
        else:
            key[best] = None
        node = (best + width) // 2
        while node:
            best, losers[node] = play(best, losers[node])
            node //= 2
    return order, keys, prefixes


def _ranks(ids: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Numbers in order of (id, place), equal for equal ones."""
    order = np.lexsort((places, ids))
    new = np.ones(len(order), bool)
    new[1:] = (ids[order][1:] != ids[order][:-1]) | (places[order][1:] != places[order][:-1])
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks


def repeats_in_order(rows: Context, prefix: np.ndarray, length: int, kmer: int) -> tuple[np.ndarray, ...]:
    """What the sorted rows of a range cover that repeat an earlier row's strings."""
    # Rows that share their piece with neither neighbour have no copy here.
    meets = np.concatenate([prefix[1:] >= _HEAD + kmer, [False]])
    meets |= np.concatenate([[False], prefix[1:] >= _HEAD + kmer])
    kept = np.flatnonzero(meets)
    between = np.minimum.reduceat(prefix, np.concatenate([[0], kept[:-1] + 1])) if len(kept) else prefix[:0]
    rows, prefix = rows.take(kept), between
    count = len(kept)
    right, left = (rows.keys[:, column].astype(np.int64) for column in (-2, -1))
    backward = np.ascontiguousarray(rows.keys[:, _HEAD + length : -2])
    order = np.argsort(backward.view(f"S{backward.shape[1]}").ravel(), kind="stable")
    differ = backward[order][1:] != backward[order][:-1]
    before = np.zeros(count, np.int64)
    before[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), backward.shape[1])
    ranks = _ranks(rows.id, rows.place)
    least = np.full(count, length)
    most = np.full(count, -1)
    for offset in range(length - kmer + 1):
        whole = np.flatnonzero((right >= length - offset) & (left >= offset))
        if len(whole) < 2:
            continue
        same_left = np.empty(count, np.int64)
        same_left[order] = np.cumsum(before < offset) if offset else 0
        classes = np.cumsum(prefix < _HEAD + length - offset) * (count + 1) + same_left
        _, member = np.unique(classes[whole], return_inverse=True)
        earliest = np.full(len(whole), count + 1)
        np.minimum.at(earliest, member, ranks[whole])
        repeat = whole[earliest[member] < ranks[whole]]
        least[repeat] = np.minimum(least[repeat], offset)
        most[repeat] = offset
    found = most >= 0
    return covered(rows.take(found), least[found], most[found], length)


def _string_hashes(rows: Context, length: int, kmer: int) -> tuple[np.ndarray, ...]:
    """Two hashes, row and offset of every string around the anchors."""
    around = np.concatenate([rows.keys[:, _HEAD + length : -2][:, ::-1], rows.keys[:, _HEAD : _HEAD + length]], axis=1)
    values = around.astype(np.uint64) + np.uint64(1)
    random = np.random.default_rng(20262).integers(1, 1 << 63, (2, length), np.uint64)
    right, left = (rows.keys[:, column].astype(np.int64) for column in (-2, -1))
    found = []
    for offset in range(length - kmer + 1):
        at = np.flatnonzero((right >= length - offset) & (left >= offset))
        part = values[at, length - kmer - offset : 2 * length - kmer - offset]
        hashes = [((part ^ (part * by)) * by).sum(axis=1) for by in random]
        hashes = [value ^ (value >> np.uint64(31)) for value in hashes]
        found.append((*hashes, at, np.full(len(at), offset)))
    return tuple(np.concatenate(columns) for columns in zip(*found))


def _first_of_each(one: np.ndarray, two: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are the earliest with their two hashes, and which come later."""
    order = np.lexsort((ranks, two, one))
    new = np.ones(len(order), bool)
    new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    head = ranks[order][np.flatnonzero(new)[np.cumsum(new) - 1]] if len(order) else ranks
    later = np.zeros(len(order), bool)
    later[order] = ranks[order] > head
    return ~later, later


def run_blocks(parts: list[Context], hot: np.ndarray, ranges: int, length: int, kmer: int) -> Iterator[tuple[int, str, bytes]]:
    """Range, kind and payload of what one run sends: sorted rows, strings, spans."""
    rows = Context(*(np.concatenate(columns) for columns in zip(*parts)))
    parts.clear()
    rows, prefix, spans = repeats_in_run(*sort_run(rows), length)
    pieces = np.ascontiguousarray(rows.keys[:, :_HEAD]).view(">u8").ravel().astype(np.uint64)
    crowded = np.isin(pieces, hot)
    where = (pieces >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
    calm = np.flatnonzero(~crowded)
    if len(calm):
        # A row's prefix with the last calm one is the least in between.
        between = np.minimum.reduceat(prefix, np.concatenate([[0], calm[:-1] + 1]))
        edges = np.flatnonzero(np.concatenate([[True], where[calm][1:] != where[calm][:-1], [True]]))
        for low, high in zip(edges[:-1], edges[1:]):
            yield int(where[calm[low]]), "run", front_coded(rows.take(calm[low:high]), between[low:high])
    ids, versions, starts, ends = spans
    if crowded.any():
        strings = rows.take(np.flatnonzero(crowded))
        one, two, at, offset = _string_hashes(strings, length, kmer)
        # One string may stand at several anchors: its start tells which is earlier.
        start = strings.place[at] - offset
        first, later = _first_of_each(one, two, _ranks(strings.id[at], start))
        ids, versions = np.concatenate([ids, strings.id[at][later]]), np.concatenate([versions, strings.version[at][later]])
        starts, ends = np.concatenate([starts, start[later]]), np.concatenate([ends, start[later] + length])
        place = one[first] % np.uint64(ranges)
        order = np.argsort(place, kind="stable")
        columns = [one[first], two[first], strings.id[at][first], strings.version[at][first], start[first]]
        columns = [column[order] for column in columns]
        edges = np.flatnonzero(np.concatenate([[True], np.diff(place[order]) != 0, [True]]))
        for low, high in zip(edges[:-1], edges[1:]):
            part = [pa.array(column[low:high]) for column in columns]
            yield int(place[order][low]), "strings", _block(part, ["one", "two", "id", "version", "start"])
    if len(ids):
        part = [pa.array(column) for column in (ids, versions, starts, ends)]
        yield int(ids[0] % ranges), "spans", _block(part, ["id", "version", "start", "end"])


def text_blocks(batches: Iterator[pa.RecordBatch], ranges: int, length: int, kmer: int) -> Iterator[tuple[int, str, bytes]]:
    """The blocks of all runs of a task, each of about ``RUN_ROWS`` suffixes."""
    parts: list[Context] = []
    hot: list[np.ndarray] = []
    held = 0
    for batch in batches:
        for at in range(batch.num_rows):
            found = batch.column(3)[at].values
            # Repeated rows bring their anchors as often.
            place, own = np.unique(found.field("place").to_numpy(), return_index=True)
            pieces = spread(found.field("piece").to_numpy().view(np.uint64)[own])
            is_hot = found.field("hot").to_numpy(zero_copy_only=False)[own]
            doc_id, version, text = (batch.column(column)[at].as_py() for column in range(3))
            for low in range(0, len(place), RUN_ROWS):
                cut = slice(low, low + RUN_ROWS)
                keys = context_keys(text, place[cut], pieces[cut], length, kmer)
                ids, versions = np.full(len(keys), doc_id, np.int64), np.full(len(keys), version, np.int64)
                parts.append(Context(keys, ids, versions, place[cut].astype(np.int64)))
                hot.append(pieces[cut][is_hot[cut]])
                held += len(keys)
                if held >= RUN_ROWS:
                    yield from run_blocks(parts, np.unique(np.concatenate(hot)), ranges, length, kmer)
                    parts, hot, held = [], [], 0
    if parts:
        yield from run_blocks(parts, np.unique(np.concatenate(hot)), ranges, length, kmer)


def make_runs(joined: DataFrame, ranges: int, length: int = LENGTH, kmer: int = KMER) -> DataFrame:
    """``range, kind, payload``: blocks of sorted runs, of strings and of spans.

    ``joined`` has ``id, version, raw, found``; the last lists place, piece and
    whether the piece is hot.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int32(), pa.string(), pa.binary())
        for block in text_blocks(batches, ranges, length, kmer):
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(block, kinds)], names=["range", "kind", "payload"])

    small_batches(joined.sparkSession, TEXTS_PER_BATCH)
    return joined.mapInArrow(run, "range int, kind string, payload binary")


def merge_range(table: pa.Table, length: int, kmer: int) -> pa.Table:
    """``id, version, start, end`` of what is repeated, from the blocks of one range."""
    found: list[tuple] = []
    runs, columns, strings = [], [], []
    for kind, payload in zip(table.column("kind").to_pylist(), table.column("payload").to_pylist()):
        batch = _unblock(payload)
        if kind == "run":
            runs.append((batch.column("prefix").to_pylist(), batch.column("tail").to_pylist()))
            columns.append([batch.column(name).to_numpy() for name in ("id", "version", "place")])
        elif kind == "strings":
            strings.append([batch.column(name).to_numpy() for name in batch.schema.names])
        else:
            found.append(tuple(batch.column(name).to_numpy() for name in batch.schema.names))
    if runs:
        order, keys, prefix = merge_runs(runs)
        base = np.cumsum([0, *(len(tails) for _, tails in runs)])
        at = np.array([base[run] + row for run, row in order], np.int64)
        ids, versions, places = (np.concatenate(parts)[at] for parts in zip(*columns))
        matrix = np.frombuffer(b"".join(keys), np.uint8).reshape(len(keys), -1)
        found.append(repeats_in_order(Context(matrix, ids, versions, places), np.array(prefix, np.int64), length, kmer))
    if strings:
        one, two, ids, versions, starts = (np.concatenate(parts) for parts in zip(*strings))
        later = _first_of_each(one, two, _ranks(ids, starts))[1]
        found.append((ids[later], versions[later], starts[later], starts[later] + length))
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64())
    merged = [np.concatenate(parts) for parts in zip(*found)] if found else [()] * 4
    return pa.table([pa.array(c, k) for c, k in zip(merged, kinds)], names=["id", "version", "start", "end"])


def repeated_spans(texts: DataFrame, length: int = LENGTH, kmer: int = KMER, hot: int = HOT_ANCHORS) -> DataFrame:
    """``id, version, start, end`` of repeated bytes of ``id, version, raw``; they overlap."""
    if kmer & (kmer - 1) or kmer > length or length > 250:
        raise ValueError("kmer has to be a power of two, and length from there to 250")
    shared = shared_anchors(texts, length, kmer, hot)
    ranges = 1 + shared.count() // RANGE_ROWS
    # Repeated rows have the same anchors: a set holds them once, however many rows there are.
    by_text = shared.groupBy("id", "version").agg(
        F.collect_set(F.struct("place", "piece", "hot")).alias("found")
    )
    joined = texts.join(by_text, ["id", "version"]).select("id", "version", "raw", "found")
    runs = make_runs(joined, ranges, length, kmer)

    def merge(table: pa.Table) -> pa.Table:
        return merge_range(table, length, kmer)

    return runs.groupBy("range").applyInArrow(merge, "id long, version long, start long, end long")


def cut_out(raw: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """The bytes outside the spans, and the number of runs of removed bytes."""
    kept, at, runs, reach = [], 0, 0, -1
    for start, end in sorted(spans):
        if start > reach:
            runs += 1
        if start > at:
            kept.append(raw[at:start])
        at = max(at, end)
        reach = max(reach, end)
    kept.append(raw[at:])
    return b"".join(kept), runs


def remove_repeats(documents: DataFrame, length: int = LENGTH, kmer: int = KMER, hot: int = HOT_ANCHORS) -> DataFrame:
    """``doc_id, kept, n_bytes, n_spans``: the bytes that are left of each text."""
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    doc_id = F.col("doc_id").cast("long")
    # The same three columns in both joins by text: it is exchanged once for both.
    # A null id comes first, as the least one does; the version's last bit tells them apart.
    version = F.xxhash64(raw, F.octet_length(raw)).bitwiseAND(F.lit(~1)).bitwiseOR(doc_id.isNull().cast("long"))
    texts = documents.select(F.coalesce(doc_id, F.lit(FIRST_ID)).alias("id"), version.alias("version"), raw.alias("raw"))
    spans = repeated_spans(texts, length, kmer, hot)
    by_text = spans.groupBy("id", "version").agg(F.collect_set(F.struct("start", "end")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, sizes, runs = [], [], []
            for text, spans in zip(batch.column(1), batch.column(2)):
                found = []
                if spans.is_valid:
                    found = list(zip(*(spans.values.field(name).to_pylist() for name in ("start", "end"))))
                raw = text.as_py()
                rest, many = cut_out(raw, found)
                kept.append(rest)
                sizes.append(len(raw))
                runs.append(many)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()), pa.array(runs, pa.int64())],
                names=["doc_id", "kept", "n_bytes", "n_spans"],
            )

    named = texts.join(by_text, ["id", "version"], "left").select(
        F.when(F.col("version") % 2 == 0, F.col("id")).alias("doc_id"), "raw", "spans"
    )
    return named.mapInArrow(run, "doc_id long, kept binary, n_bytes long, n_spans long")
