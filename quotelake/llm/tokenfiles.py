"""Token ids in binary files of which a reader opens only the documents it wants.

A file is a row of independent zstandard frames. Each document has frames of its own
(one for every ``FRAME_IDS`` ids), so no other document is read for it. Then comes a
directory of the documents in a skippable frame, and last the seek table of the public
seekable format: compressed and decompressed size and checksum (low half of XXH64) of
every frame. Any zstandard tool decompresses a file to the ids of its documents, one
after another. Values are little-endian; ids have 32 bits.

=====================  ====================================================
data frames            ids of the documents in order
directory (skippable)  ``HEAD`` (mark, task, file of the task, documents), then
                       ids of documents, whether they are null, their numbers
                       of frames and of ids, XXH64 of all that
seek table             skippable, the directory's frame is the last entry
=====================  ====================================================

Documents are in ascending order of ``doc_id``, null ids first, equal ids in the order
of the table. Spark deals them to tasks by ranges of that order; tasks write files of
about ``FILE_BYTES`` through Spark's own writer, so a lost task leaves nothing behind.
That writer ends a row with a line separator: one row is one file, and the separator is
the four bytes that end a seek table.

The tokenizer's own pattern never joins what stands before a blank to it, unless that
is a blank as well. Texts are cut there, equal pieces are encoded once, and ids are
those of the whole text. Names of special tokens inside a text are text.

A null or empty text is the end token alone. Bytes that are no UTF-8 count as U+FFFD.
Repeated rows and null ids are written like any other row. An empty table leaves a
folder without documents. Columns but ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import io
import json
import os
import struct
import zlib
from collections.abc import Iterable, Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.models import BPE

from quotelake.llm.common import batches_of, give_back

END_TOKEN = 2
# Ids of one frame, bytes of one file and of one task's text.
FRAME_IDS = 1 << 18
FILE_BYTES = 16_000_000
TASK_BYTES = 64_000_000
# Texts are encoded together up to so many bytes; a longer one goes in pieces.
GROUP_BYTES = 4_000_000
# What a row counts besides its text.
ROW_BYTES = 64
# A worker forgets the pieces it knows beyond so many; so many are encoded as one text.
KEPT_PIECES = 1_500_000
JOINED = 1000
# Texts of joined pieces that are with the tokenizer at a time.
TEXTS = 16

# Fixed values of the seekable format, and the mark of a directory.
DIRECTORY_MAGIC = 0x184D2A50
SEEK_MAGIC = 0x184D2A5E
FOOTER_MAGIC = 0x8F92EAB1
CHECKSUMS = 0x80
HEAD = "<8sIII"
MARK = b"tokenid1"


BLANKS = b"\t\n\v\f\r "
BLANK = np.isin(np.arange(256), list(BLANKS))


def sure_cuts(data: np.ndarray) -> np.ndarray:
    """Where a blank of ASCII follows what is certainly none.

    The byte before tells for ASCII. Of longer characters those are left out whose
    first bytes some blank beyond ASCII has as well (C2; E1 9A; E2 80 and 81; E3 80).
    """
    at = np.flatnonzero(BLANK[data])
    at = at[at > 0]
    last = data[at - 1]
    sure = (last > 0x20) & (last < 0x7F)
    wide = at[last >= 0x80]
    one, two, three = (data[np.maximum(wide - back, 0)] for back in (2, 3, 4))
    pair = (one >= 0xC3) & (one < 0xE0)
    maybe = (two >= 0xE1) & (two <= 0xE3) & ((one == 0x9A) | (one == 0x80) | (one == 0x81))
    sure[last >= 0x80] = pair | ((two >= 0xE0) & (two < 0xF0) & ~maybe) | (three >= 0xF0)
    return at[sure]


def parts_of(text: bytes, size: int = GROUP_BYTES) -> Iterator[bytes]:
    """A text in parts of about ``size`` bytes, cut where the tokenizer cuts."""
    at = 0
    while len(text) - at > size:
        end = at + size
        while True:
            cuts = sure_cuts(np.frombuffer(text, np.uint8, min(size, len(text) - end + 4), end - 4))
            cuts = cuts[cuts >= 4]
            if len(cuts) or end + size >= len(text):
                break
            end += size - 4
        if not len(cuts):
            break
        yield text[at : end - 4 + int(cuts[0])]
        at = end - 4 + int(cuts[0])
    yield text[at:]


def _utf8(text: bytes) -> bytes:
    try:
        text.decode("utf-8")
        return text
    except UnicodeDecodeError:
        return text.decode("utf-8", "replace").encode("utf-8")


def _uncached(path: str) -> Tokenizer:
    """The tokenizer of a file without the cache of its model, as no piece comes twice."""
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    with open(path, encoding="utf-8") as handle:
        model = json.load(handle)["model"]
    if model.pop("type", "BPE") == "BPE":
        merges = [tuple(merge.split(" ")) if isinstance(merge, str) else tuple(merge) for merge in model.pop("merges")]
        tokenizer.model = BPE(model.pop("vocab"), merges, cache_capacity=0, **{k: v for k, v in model.items() if v is not None})
    return tokenizer


class Encoder:
    """Ids of texts by a byte-level tokenizer; pieces met before are not encoded again."""

    def __init__(self, path: str):
        self.tokenizer = _uncached(path)
        names = self.tokenizer.get_vocab()
        # A name has one character for each byte of its token.
        self.bytes_of = np.zeros(max(names.values()) + 1, np.int32)
        self.bytes_of[list(names.values())] = [len(name) for name in names]
        self._restart()

    def _restart(self) -> None:
        self.known = pa.array([], pa.binary())
        self.low, self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint32)

    def _learn(self, new: list[bytes]) -> np.ndarray:
        """The places that new pieces get.

        Pieces that begin with a blank and certainly end in none go together: the
        lengths of the tokens tell where each ends.
        """
        plain, odd, places = [], [], np.zeros(len(new), np.int64)
        for at, piece in enumerate(new):
            if piece[0] in BLANKS and (0x20 < piece[-1] < 0x7F or 0xC3 <= piece[-2 % len(piece)] < 0xE0):
                plain.append(piece)
            else:
                places[at] = 1
                odd.append(piece)
        places = len(self.known) + np.where(places > 0, len(plain) + np.cumsum(places) - 1, np.arange(len(new)) - np.cumsum(places))
        texts = [plain[at : at + JOINED] for at in range(0, len(plain), JOINED)] + [[piece] for piece in odd]
        flat, sizes, held = [self.flat], [self.size], len(self.flat)
        for at in range(0, len(texts), TEXTS):
            some = texts[at : at + TEXTS]
            whole = [b"".join(pieces).decode("utf-8") for pieces in some]
            for pieces, encoding in zip(some, self.tokenizer.encode_batch_fast(whole, add_special_tokens=False)):
                ids = np.array(encoding.ids, np.uint32)
                flat.append(ids)
                if len(pieces) == 1:
                    sizes.append(np.array([len(ids)], np.int32))
                    continue
                ends, after = np.cumsum([*map(len, pieces)]), np.cumsum(self.bytes_of[ids])
                through = np.searchsorted(after, ends, "right")
                if not (after[through - 1] == ends).all():
                    raise ValueError("the tokenizer joined pieces of text that its pattern keeps apart")
                sizes.append(np.diff(through, prepend=0).astype(np.int32))
        self.known = pa.concat_arrays([self.known, pa.array(plain + odd, pa.binary())])
        added = np.concatenate(sizes[1:]).astype(np.int64)
        self.low = np.concatenate([self.low, held + np.cumsum(added) - added])
        self.size, self.flat = np.concatenate(sizes), np.concatenate(flat)
        return places

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text (valid UTF-8), without the end token."""
        if len(self.known) > KEPT_PIECES:
            self._restart()
        begin = np.cumsum([0, *map(len, texts)])
        raw = b"".join(texts)
        data = np.frombuffer(raw, np.uint8)
        first = np.zeros(len(data) + 1, bool)
        first[sure_cuts(data)] = True
        first[begin] = True
        edges = np.flatnonzero(first).astype(np.int32)
        pieces = pa.BinaryArray.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(raw)])
        pieces = pieces.dictionary_encode()
        found = pa.compute.index_in(pieces.dictionary, self.known)
        rows = found.fill_null(-1).to_numpy().astype(np.int64)
        if found.null_count:
            rows[rows < 0] = self._learn(pieces.dictionary.filter(found.is_null()).to_pylist())
        row = rows[pieces.indices.to_numpy()]
        sizes = self.size[row]
        after = np.cumsum(sizes, dtype=np.int64)
        ids = np.arange(after[-1] if len(after) else 0)
        ids += np.repeat(self.low[row] - after + sizes, sizes)
        ids = self.flat[ids]
        # Pieces end with their text.
        bounds = np.append(0, after)[np.searchsorted(edges, begin)]
        return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


class FileBuilder:
    """Puts together one file."""

    def __init__(self, part: int, number: int):
        self.part, self.number = part, number
        self.compressor = zstandard.ZstdCompressor(write_checksum=False)
        self.frames: list[bytes] = []
        self.table: list[tuple[int, int, int]] = []
        self.documents: list[tuple[int | None, int, int]] = []
        self.size, self.many, self.begun = 0, 0, 0

    def add(self, ids: np.ndarray) -> None:
        """More ids of the document at hand."""
        for at in range(0, len(ids), FRAME_IDS):
            raw = ids[at : at + FRAME_IDS].astype("<u4").tobytes()
            self._frame(self.compressor.compress(raw), raw)
        self.many += len(ids)

    def _frame(self, frame: bytes, raw: bytes) -> None:
        self.frames.append(frame)
        self.table.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.size += len(frame)

    def end_document(self, doc_id: int | None) -> None:
        self.documents.append((doc_id, len(self.table) - self.begun, self.many))
        self.begun, self.many = len(self.table), 0

    def content(self) -> bytes:
        """The file, without the last four bytes of its footer."""
        rows = self.documents
        listed = struct.pack(HEAD, MARK, self.part, self.number, len(rows))
        listed += np.array([row[0] or 0 for row in rows], "<i8").tobytes()
        listed += np.array([row[0] is None for row in rows], "u1").tobytes()
        listed += np.array([row[1] for row in rows], "<u4").tobytes()
        listed += np.array([row[2] for row in rows], "<u8").tobytes()
        listed += struct.pack("<Q", xxhash.xxh64_intdigest(listed))
        self._frame(struct.pack("<II", DIRECTORY_MAGIC, len(listed)) + listed, b"")
        entries = np.array(self.table, "<u4").tobytes()
        seek = struct.pack("<II", SEEK_MAGIC, len(entries) + 9) + entries + struct.pack("<IB", len(self.table), CHECKSUMS)
        return b"".join([*self.frames, seek])


class TokenFile:
    """Reads from any open file; only the end of it and the frames asked for."""

    def __init__(self, handle: BinaryIO):
        self.handle = handle
        end = handle.seek(0, io.SEEK_END)
        frames, flags, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != FOOTER_MAGIC or not flags & CHECKSUMS:
            raise ValueError("not a file of token ids: no seek table with checksums")
        table = self._at(end - 9 - 12 * frames, 12 * frames)
        self.table = np.frombuffer(table, "<u4").reshape(-1, 3).astype(np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.table[:, 0])])
        listed = self._at(int(self.offsets[-2]) + 8, int(self.table[-1, 0]) - 8)
        mark, self.part, self.number, many = struct.unpack_from(HEAD, listed)
        if mark != MARK or struct.unpack("<Q", listed[-8:])[0] != xxhash.xxh64_intdigest(listed[:-8]):
            raise ValueError("the directory of documents is damaged")
        columns, at = [], struct.calcsize(HEAD)
        for kind in ("<i8", "u1", "<u4", "<u8"):
            columns.append(np.frombuffer(listed, kind, many, at))
            at += many * np.dtype(kind).itemsize
        self.ids, self.null = columns[0], columns[1].astype(bool)
        self.sizes = columns[3].astype(np.int64)
        self.begin = np.concatenate([[0], np.cumsum(columns[2], dtype=np.int64)])
        self.start = np.cumsum(self.sizes) - self.sizes

    def __len__(self) -> int:
        return len(self.ids)

    def _at(self, place: int, size: int) -> bytes:
        self.handle.seek(place)
        return self.handle.read(size)

    def doc_id(self, row: int) -> int | None:
        return None if self.null[row] else int(self.ids[row])

    def rows_of(self, doc_id: int | None) -> range:
        """Documents of that id: a binary search in the ascending ids."""
        nulls = int(self.null.sum())
        if doc_id is None:
            return range(nulls)
        low, high = (nulls + int(np.searchsorted(self.ids[nulls:], doc_id, side)) for side in ("left", "right"))
        return range(low, high)

    def read(self, row: int) -> np.ndarray:
        """Ids of one document, with the end token; its frames are checked."""
        low, high = int(self.begin[row]), int(self.begin[row + 1])
        raw = self._at(int(self.offsets[low]), int(self.offsets[high] - self.offsets[low]))
        found, at = [], 0
        for size, plain, checksum in self.table[low:high].tolist():
            part = zstandard.ZstdDecompressor().decompress(raw[at : at + size], max_output_size=plain)
            if len(part) != plain or xxhash.xxh64_intdigest(part) & 0xFFFFFFFF != checksum:
                raise ValueError(f"a frame of document {self.doc_id(row)} is damaged")
            found.append(part)
            at += size
        return np.frombuffer(b"".join(found), "<u4")


def write_tokens(documents: DataFrame, path: str, tokenizer: str, end_token: int = END_TOKEN) -> None:
    """Encode all documents into files in the new folder ``path``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text, F.monotonically_increasing_id().alias("place"))
    total = documents.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    tasks = 1 + total // TASK_BYTES
    order = [F.asc_nulls_first("doc_id"), F.asc("place")]

    def whole(file: FileBuilder) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([file.content()], pa.binary())], names=["file"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        encoder, part, number = Encoder(tokenizer), TaskContext.get().partitionId(), 0
        file = FileBuilder(part, number)
        for group in _groups(batches):
            for (doc_id, _, last), ids in zip(group, encoder.encode([text for _, text, _ in group])):
                file.add(np.append(ids, np.uint32(end_token)) if last else ids)
                if not last:
                    continue
                file.end_document(doc_id)
                if file.size >= FILE_BYTES:
                    yield whole(file)
                    number += 1
                    file = FileBuilder(part, number)
                    give_back()
        if file.documents:
            yield whole(file)
        del encoder, file
        give_back()

    with batches_of(documents.sparkSession):
        dealt = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order).select("doc_id", "text")
        files = dealt.mapInArrow(run, "file binary").select(F.col("file").cast("string").alias("value"))
        # The separator after the one row of a file is the end of its footer.
        ending = struct.pack("<I", FOOTER_MAGIC).decode("latin-1")
        files.write.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1").option("lineSep", ending).text(path)


Piece = tuple[int | None, bytes, bool]


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[list[Piece]]:
    """Ids and texts, long texts in parts (true: the last), so many bytes at a time."""
    held: list[Piece] = []
    size = 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            before = None
            for part in parts_of(_utf8(text.as_py())):
                if before is not None:
                    held.append((doc_id, before, False))
                before = part
                size += len(part) + ROW_BYTES
                if size >= GROUP_BYTES and held:
                    yield held
                    held, size = [], len(part) + ROW_BYTES
            held.append((doc_id, before or b"", True))
    if held:
        yield held


def _files(spark: SparkSession, path: str) -> DataFrame:
    """Whole files; a task that had no documents may have left an empty one."""
    return spark.read.format("binaryFile").load(path).where("length > 0").select("content")


def list_documents(spark: SparkSession, path: str) -> DataFrame:
    """``part, number, doc_id, offset, n_tokens, ids_crc32`` of every document, read from its
    frames: ``offset`` counts the ids before it in the file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                file = TokenFile(io.BytesIO(content.as_py()))
                read = [(len(ids), zlib.crc32(ids.tobytes())) for ids in map(file.read, range(len(file)))]
                many = np.array(read, np.int64).reshape(-1, 2)
                columns = [
                    pa.array(np.full(len(file), file.part, np.int64)),
                    pa.array(np.full(len(file), file.number, np.int64)),
                    pa.array(file.ids, mask=file.null),
                    pa.array(file.start),
                    pa.array(many[:, 0]),
                    pa.array(many[:, 1]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "number", "doc_id", "offset", "n_tokens", "ids_crc32"])
                give_back()

    return _files(spark, path).mapInArrow(run, "part long, number long, doc_id long, offset long, n_tokens long, ids_crc32 long")


def read_tokens(spark: SparkSession, path: str, wanted: list[int | None] | None = None) -> DataFrame:
    """``doc_id, ids`` of the documents asked for (all if None); no other frame is opened."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                file = TokenFile(io.BytesIO(content.as_py()))
                rows = range(len(file)) if wanted is None else [row for key in dict.fromkeys(wanted) for row in file.rows_of(key)]
                for row in rows:
                    ids = pa.array([file.read(row).astype(np.int64)], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array([file.doc_id(row)], pa.int64()), ids], names=["doc_id", "ids"])

    return _files(spark, path).mapInArrow(run, "doc_id long, ids array<long>")
