from __future__ import annotations

import io
import random
import struct
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quotelake.llm import queries, tokenfiles
from tests.llm.helpers import ODD_ROWS, documents, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = [
    *"abcXYZ019 \n\t\r\x0b\x0c'.,-éßñт中ひ\u0085 　    \U0001f600\x1c\x1f\x00\x7f﻿̀",
    "'s", "'ll", "<|endoftext|>", "  ", "the ",
]


@pytest.fixture(scope="module")
def tokenizer():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return tokenizer


@pytest.fixture(scope="module")
def encoder():
    return tokenfiles.Encoder(PATH)


def ids_of(tokenizer, text: str | None) -> list[int]:
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def files_in(path) -> list[tokenfiles.TokenFile]:
    found = [tokenfiles.TokenFile(io.BytesIO(file.read_bytes())) for file in Path(path).glob("part-*") if file.stat().st_size]
    return sorted(found, key=lambda file: (file.part, file.number))


def test_ids_are_those_of_whole_texts(tokenizer, encoder):
    pick = random.Random(1)
    for _ in range(300):
        texts = ["".join(pick.choice(ALPHABET) for _ in range(pick.choice([0, 1, 3, 10, 60]))) for _ in range(8)]
        got = [ids.tolist() for ids in encoder.encode([text.encode() for text in texts])]
        assert got == [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]


def test_parts_of_long_texts(tokenizer, encoder):
    pick = random.Random(2)
    for _ in range(100):
        text = "".join(pick.choice(ALPHABET) for _ in range(300))
        parts = list(tokenfiles.parts_of(text.encode(), 40))
        assert b"".join(parts) == text.encode()
        ids = [each for part in encoder.encode(parts) for each in part.tolist()]
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids
    assert list(tokenfiles.parts_of(b"x" * 1000, 40)) == [b"x" * 1000] and list(tokenfiles.parts_of(b"")) == [b""]


def test_pieces_are_forgotten_and_learned_again(tokenizer, monkeypatch):
    monkeypatch.setattr(tokenfiles, "KEPT_PIECES", 5)
    encoder = tokenfiles.Encoder(PATH)
    for seed in range(5):
        text = prose(seed, 60)
        assert encoder.encode([text.encode()])[0].tolist() == ids_of(tokenizer, text)[:-1]


def test_round_trip_of_odd_rows(spark, tokenizer, tmp_path):
    rows = [*ODD_ROWS, (None, None), (None, "second without an id"), (-5, "below zero"), (-(2**63), "least"), (2**63 - 1, "most")]
    tokenfiles.write_tokens(documents(spark, rows), path := str(tmp_path / "files"), PATH)
    got = sorted(((row.doc_id, row.ids) for row in tokenfiles.read_tokens(spark, path).collect()), key=repr)
    assert got == sorted(((key, ids_of(tokenizer, text)) for key, text in rows), key=repr)
    keys = [file.doc_id(row) for file in files_in(path) for row in range(len(file))]
    assert keys == sorted(keys, key=lambda key: (key is not None, key))
    tokenfiles.write_tokens(documents(spark, rows).limit(0), empty := str(tmp_path / "empty"), PATH)
    assert tokenfiles.read_tokens(spark, empty).collect() == tokenfiles.list_documents(spark, empty).collect() == []


def test_text_that_is_no_utf8(spark, tokenizer, tmp_path):
    rows = spark.range(1).select(F.lit(1).alias("doc_id"), F.expr("CAST(X'61FF2062C3' AS STRING)").alias("text"))
    tokenfiles.write_tokens(rows, path := str(tmp_path / "files"), PATH)
    assert tokenfiles.read_tokens(spark, path).first().ids == ids_of(tokenizer, "a� b�")


def test_long_documents_and_small_files(spark, tokenizer, tmp_path, monkeypatch):
    for name, value in (("GROUP_BYTES", 300), ("FRAME_IDS", 50), ("FILE_BYTES", 400), ("TASK_BYTES", 4000)):
        monkeypatch.setattr(tokenfiles, name, value)
    rows = [(at, prose(at, 1 + at * 7 % 90)) for at in range(60)] + [(60, prose(60, 2000))]
    tokenfiles.write_tokens(documents(spark, rows), path := str(tmp_path / "files"), PATH)
    files = files_in(path)
    assert len({file.part for file in files}) > 3 and max(file.number for file in files) > 1
    assert [(file.doc_id(row), file.read(row).tolist()) for file in files for row in range(len(file))] == [
        (key, ids_of(tokenizer, text)) for key, text in rows
    ]
    assert max(np.diff(file.begin).max() for file in files) > 50


def test_files_are_those_of_the_seekable_format(spark, tokenizer, tmp_path):
    rows = [(at, prose(at, 30)) for at in range(20)]
    tokenfiles.write_tokens(documents(spark, rows).coalesce(1), path := str(tmp_path / "files"), PATH)
    (file,) = [file for file in Path(path).glob("part-*") if file.stat().st_size]
    raw = file.read_bytes()
    whole = b""
    frames, flags, magic = struct.unpack("<IBI", raw[-9:])
    assert magic == 0x8F92EAB1 and flags == 0x80 and frames == 21
    skip, size = struct.unpack("<II", raw[-17 - 12 * frames : -9 - 12 * frames])
    assert skip == 0x184D2A5E and size == 12 * frames + 9
    at = 0
    for packed, plain, checksum in struct.iter_unpack("<III", raw[-9 - 12 * frames : -9]):
        frame = raw[at : at + packed]
        at += packed
        if plain:
            whole += (part := zstandard.ZstdDecompressor().decompress(frame))
            assert len(part) == plain and xxhash.xxh64_intdigest(part) & 0xFFFFFFFF == checksum
        else:
            assert frame[:4] == struct.pack("<I", 0x184D2A50)
    assert at == len(raw) - 17 - 12 * frames
    assert np.frombuffer(whole, "<u4").tolist() == [each for _, text in rows for each in ids_of(tokenizer, text)]


class Watched(io.BytesIO):
    """Notes which bytes are read."""

    def __init__(self, raw: bytes):
        super().__init__(raw)
        self.spans: list[tuple[int, int]] = []

    def read(self, size: int = -1) -> bytes:
        self.spans.append((self.tell(), self.tell() + size))
        return super().read(size)


def test_only_requested_documents_are_read(spark, tokenizer, tmp_path):
    rows = [(at, prose(at, 200)) for at in range(30)] + [(7, "the same id"), (None, "none")]
    tokenfiles.write_tokens(documents(spark, rows).coalesce(1), path := str(tmp_path / "files"), PATH)
    (place,) = [file for file in Path(path).glob("part-*") if file.stat().st_size]
    raw = bytearray(place.read_bytes())
    file = tokenfiles.TokenFile(watched := Watched(bytes(raw)))
    watched.spans.clear()
    (row,) = file.rows_of(12)
    assert file.read(row).tolist() == ids_of(tokenizer, rows[12][1])
    assert watched.spans == [(int(file.offsets[row]), int(file.offsets[row + 1]))]
    assert len(file.rows_of(7)) == 2 and len(file.rows_of(None)) == 1 and len(file.rows_of(99)) == 0
    # Damage to another document does not matter; to this one it is found.
    raw[int(file.offsets[row + 1]) + 20] ^= 0xFF
    damaged = tokenfiles.TokenFile(io.BytesIO(bytes(raw)))
    assert damaged.read(row).tolist() == ids_of(tokenizer, rows[12][1])
    with pytest.raises((ValueError, zstandard.ZstdError)):
        damaged.read(row + 1)
    got = {row.doc_id: row.ids for row in tokenfiles.read_tokens(spark, path, [12, None, 99]).collect()}
    assert got == {12: ids_of(tokenizer, rows[12][1]), None: ids_of(tokenizer, "none")}


def test_damaged_files_are_refused(spark, tmp_path):
    tokenfiles.write_tokens(documents(spark, [(1, "a b c")]).coalesce(1), path := str(tmp_path / "files"), PATH)
    (place,) = [file for file in Path(path).glob("part-*") if file.stat().st_size]
    raw = place.read_bytes()
    file = tokenfiles.TokenFile(io.BytesIO(raw))
    listed = bytearray(raw)
    listed[int(file.offsets[-2]) + 20] ^= 1
    for bad in (raw[:-1], bytes(listed)):
        with pytest.raises(ValueError):
            tokenfiles.TokenFile(io.BytesIO(bad))


def test_one_id_is_dealt_over_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfiles, "TASK_BYTES", 5000)
    rows = [(None, prose(at, 30)) for at in range(200)] + [(at, prose(at, 30)) for at in range(100)]
    tokenfiles.write_tokens(documents(spark, rows), path := str(tmp_path / "files"), PATH)
    sizes = [len(file) for file in files_in(path)]
    assert sum(sizes) == len(rows) and len(sizes) > 8 and max(sizes) < 60


def test_query_on_the_given_tables(spark, sf_dir, tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    got = {row.doc_id: (row.start, row.n_tokens, row.ids_crc32) for row in queries.op13_tokens(spark, sf_dir).collect()}
    before = 0
    for doc_id, text in docs:
        ids = ids_of(tokenizer, text)
        assert got[doc_id] == (before, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        before += len(ids)
    assert len(got) == len(docs)
