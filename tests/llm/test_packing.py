from __future__ import annotations

import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pyspark.sql import functions as F

from quotelake.llm import packing
from tests.llm.helpers import ODD_ROWS, documents, prose

PATH = public_tokenizers.path("word_bpe_49k.json")


def expected_ids(text):
    return np.array([*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 2], "<u4")


def check(pieces, rows):
    """Every id in one piece, sequences gapless and of allowed sizes."""
    want, got = defaultdict(list), defaultdict(list)
    for doc_id, text in rows:
        want[doc_id].append(expected_ids(text))
    for piece in pieces:
        got[piece.doc_id].append(piece)
    assert set(want) == set(got)
    for doc_id, versions in want.items():
        ids = versions[0]
        covered = np.zeros(len(ids), int)
        for piece in got[doc_id]:
            part = ids[piece.start : piece.start + piece.length]
            assert (piece.doc_tokens, len(part)) == (len(ids), piece.length)
            assert piece.ids_crc32 == zlib.crc32(part.tobytes())
            covered[piece.start : piece.start + piece.length] += 1
        assert (covered == len(versions)).all()
    sequences = defaultdict(list)
    for piece in pieces:
        sequences[piece.sequence_id].append((piece.offset, piece.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.WINDOW and at & (at - 1) == 0
    return sequences


@pytest.mark.parametrize("shard_bytes", [300, 10**7])
def test_every_token_in_one_piece(spark, shard_bytes):
    rows = [(i, text) for i, (_, text) in enumerate(ODD_ROWS)] + [(i, prose(i % 40, 20 * (i % 30))) for i in range(100, 300)]
    rows += [(400, "Punct. ,, end., a.b 3.5 it's I'M <|endoftext|> x y z \x1c!\x1d é É ﬁ ① . ΟΔΟΣ İx Ǆ"), (401, "Á ́x\n\n.,\t,.")]
    pieces = packing.pack_documents(documents(spark, rows), PATH, shard_bytes).collect()
    assert {piece.doc_id for piece in pieces} == {i for i, _ in rows}
    # Names of special tokens inside a text count as text.
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    for doc_id, text in rows:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        own = [piece for piece in pieces if piece.doc_id == doc_id]
        assert sum(piece.length for piece in own) == len(ids)
        for piece in own:
            assert piece.ids_crc32 == zlib.crc32(ids[piece.start : piece.start + piece.length].tobytes())


def test_sequences_are_gapless(spark):
    rows = [(i, prose(i, 150)) for i in range(200)]
    sequences = check(packing.pack_documents(documents(spark, rows), PATH).collect(), rows)
    assert sum(sum(size for _, size in parts) == packing.WINDOW for parts in sequences.values()) > 0


def test_nulls_repeats_and_empty_table(spark):
    pieces = packing.pack_documents(documents(spark, ODD_ROWS), PATH).collect()
    check(pieces, ODD_ROWS)
    assert packing.pack_documents(documents(spark, ODD_ROWS).limit(0), PATH).collect() == []


def test_neighbours_are_those_of_brute_force():
    texts = [prose(i % 7, 60) + f" only{i}" for i in range(30)]
    shard = packing.Shard([text.encode() for text in texts], packing.WordTokens(PATH))
    unused = np.ones(len(texts), bool)
    unused[3] = False
    found = list(shard.neighbours(shard.query(3), unused))
    assert 3 not in found
    assert set(found[:4]) == {10, 17, 24} | {found[3]}


def bm25_order(shard, doc, unused):
    """All unused documents with a word of one, by scores over all of its words."""
    own = set(shard.term[shard.word_of_doc[doc] : shard.word_of_doc[doc + 1]].tolist())
    lengths = np.diff(shard.word_of_doc)
    scores = []
    for other in range(shard.count):
        words = shard.term[shard.word_of_doc[other] : shard.word_of_doc[other + 1]].tolist()
        score = 0.0
        for word in own & set(words):
            if shard.among[word] > 1:
                many = words.count(word)
                norm = packing.K1 * (1 - packing.B + packing.B * lengths[other] / lengths.mean())
                score += float(np.float32(shard.idf[word] * many * (packing.K1 + 1) / (many + norm)))
        if score and unused[other]:
            scores.append((-score, other))
    return [other for _, other in sorted(scores)]


@pytest.mark.parametrize("best", [2, 8, 32, 1000])
def test_neighbours_of_long_seeds_are_by_all_words(monkeypatch, best):
    monkeypatch.setattr(packing, "BEST", best)
    rare = [" ".join(f"topic{(i * 7 + k) % 90}" for k in range(i % 60)) for i in range(150)]
    texts = [prose(i % 50, 30 + 5 * (i % 41)) + " " + rare[i] for i in range(150)]
    shard = packing.Shard([text.encode() for text in texts], packing.WordTokens(PATH))
    unused = np.ones(len(texts), bool)
    unused[::9] = False
    for seed in (16, 40, 59, 119):
        unused[seed] = False
        assert len(shard.query(seed)) > 40
        want = bm25_order(shard, seed, unused)
        assert list(shard.neighbours(shard.query(seed), unused)) == want
        # Documents that are used up meanwhile are left out of the rest.
        left = unused.copy()
        got = []
        for doc in shard.neighbours(shard.query(seed), left):
            got.append(doc)
            left[doc] = False
            left[want[5]] = False
        assert got == [doc for doc in want if doc != want[5]]


def test_windows_hold_the_best_neighbours_in_order():
    texts = [prose(i, 200 + i) for i in range(60)]
    shard = packing.Shard([text.encode() for text in texts], packing.WordTokens(PATH))
    pieces = list(packing.Packer(0).pack(shard, list(range(60))))
    unused = np.ones(60, bool)
    unused[0] = False
    first = [piece.doc_id for piece in pieces if piece.sequence_id == 0]
    assert first == [0, *bm25_order(shard, 0, unused)[: len(first) - 1]]


def test_one_window_takes_like_documents(spark):
    rows = [(i, f"{'alpha' if i % 2 else 'omega'}word{i % 2} " * 300) for i in range(40)]
    pieces = packing.pack_documents(documents(spark, rows).coalesce(1), PATH).collect()
    kinds = defaultdict(set)
    for piece in pieces:
        kinds[piece.sequence_id].add(piece.doc_id % 2)
    mixed = sum(len(kind) == 2 for kind in kinds.values())
    assert mixed <= 2


def test_words_that_share_a_hash_are_told_apart():
    text = b"aa bb aa cc"
    buffer = np.frombuffer(text, np.uint8)
    words = packing.find_words(buffer)
    first, term = packing._told_apart(buffer, words)
    assert term.tolist() == [0, 1, 0, 2] and first.tolist() == [0, 1, 3]


def test_null_ids_and_empty_texts_are_spread_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(packing, "TASK_BYTES", 40_000)
    for rows in ([(None, "the same long wordings here " * 4)] * 3000, [(None, "")] * 6000):
        dealt = packing.deal_out(documents(spark, rows, clash=False).repartition(4)).groupBy(F.spark_partition_id()).count().collect()
        sizes = [row["count"] for row in dealt]
        assert sum(sizes) == len(rows) and len(sizes) > 8 and max(sizes) < len(rows) / 4


def test_a_shard_needs_little_beside_its_text():
    texts = [prose(i, 3000).encode() for i in range(200)]
    size = sum(map(len, texts))
    tokens = packing.WordTokens(PATH)
    packing.Shard(texts[:100], tokens)  # words and powers are kept from then on
    tracemalloc.start()
    packing.Shard(texts, tokens)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert size > 3_000_000 and peak < 7 * size, peak / size


@pytest.mark.parametrize("clash", [False, True])
def test_shards_of_small_pieces_and_of_shared_hashes_are_the_same(monkeypatch, clash):
    texts = [(prose(i % 9, 40 + i) + f" only{i} éü").encode() for i in range(40)] + [b"", b"x" * 300, b""]
    whole = packing.Shard(texts, packing.WordTokens(PATH))
    find = packing.find_words

    def find_alike(text):
        words = find(text)
        return words._replace(one=words.one % np.uint64(5))

    monkeypatch.setattr(packing, "CHUNK", 64)
    if clash:
        monkeypatch.setattr(packing, "find_words", find_alike)
    shard = packing.Shard(texts, packing.WordTokens(PATH))
    assert shard.sizes.tolist() == whole.sizes.tolist() == [len(expected_ids(text.decode())) for text in texts]
    for doc in range(len(texts)):
        assert shard.tokens(doc).tolist() == whole.tokens(doc).tolist()
        assert len(shard.query(doc)) == len(whole.query(doc))
