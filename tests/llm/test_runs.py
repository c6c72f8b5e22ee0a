from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from quotelake.llm import queries, runs
from tests.llm.helpers import ODD_ROWS, documents, prose


def plain(words: list, exponent: int = 4, least: int = 6) -> list[tuple[int, int, int]]:
    """Every lag by itself: stretches of equal words, the smallest period of each."""
    codes: dict = {}
    text = np.array([codes.setdefault(word, len(codes)) for word in words], np.int64)
    found, seen = [], set()
    for lag in range(1, len(words) // exponent + 1):
        same = np.concatenate([[False], text[lag:] == text[:-lag], [False]]).astype(np.int8)
        for low, high in np.flatnonzero(np.diff(same)).reshape(-1, 2).tolist():
            end = high + lag
            if end - low >= max(least, exponent * lag) and (low, end) not in seen:
                seen.add((low, end))
                found.append((low, end - low, lag))
    return sorted(found, key=lambda run: (run[0], run[2]))


def some_words(pick: random.Random) -> list[bytes]:
    size, letters = pick.choice([0, 1, 5, 20, 60, 150]), pick.choice([1, 2, 3, 5])
    words = [b"%d" % pick.randrange(letters) for _ in range(size)]
    if size and pick.random() < 0.6:
        begin, period = pick.randrange(size), pick.randint(1, max(1, size // 4))
        words = [word if at < begin else words[begin + (at - begin) % period] for at, word in enumerate(words)]
        if pick.random() < 0.5:
            words[pick.randrange(size)] = b"x"
    return words


@pytest.mark.parametrize("exponent, least", [(4, 6), (2, 1), (3, 2)])
def test_same_as_every_lag_by_itself(exponent, least):
    pick = random.Random(exponent)
    for _ in range(400):
        docs = [some_words(pick) for _ in range(pick.randint(1, 4))]
        got = runs.runs_of(docs, exponent, least)
        assert [[tuple(row) for row in each.tolist()] for each in got] == [plain(doc, exponent, least) for doc in docs]


def test_words_may_come_one_by_one():
    pick = random.Random(2)
    for _ in range(100):
        words = np.array([pick.randrange(2) for _ in range(pick.randint(1, 200))])
        whole, parts, at = runs.RunCatcher(2, 1), runs.RunCatcher(2, 1), 0
        whole.append(words)
        while at < len(words):
            step = pick.choice([1, 1, 2, 7, 40])
            parts.append(words[at : at + step])
            at += step
        assert (found := whole.close()).tolist() == parts.close().tolist()
        assert [tuple(row) for row in found.tolist()] == plain(words.tolist(), 2, 1)


def test_names_that_clash_do_no_harm(monkeypatch):
    # With every name alike each block is caught at every lag: words decide.
    monkeypatch.setattr(runs, "_mixed", lambda names: np.ones(len(names), np.uint64))
    pick = random.Random(3)
    for _ in range(60):
        doc = some_words(pick)
        found = {tuple(row) for row in runs.runs_of([doc])[0].tolist()}
        assert found <= set(plain(doc))


def test_long_periodic_texts_take_no_square_of_their_length():
    for words in ([b"a"] * 300_000, [b"a", b"b", b"a", b"c"] * 75_000, ([b"a"] * 700 + [b"b"]) * 400):
        assert max(len(runs.runs_of([words])[0]), 1) <= 401


def test_odd_rows(spark):
    rows = [*ODD_ROWS, (8, "a " * 6), (9, "x a b a b a b a b y"), (10, "a a a a a"), (None, "b b b b b b")]
    got = {(row.doc_id, row.collapsed): row for row in runs.find_runs(documents(spark, rows)).collect()}
    assert got[8, "a"].runs == [(0, 6, 1)] and got[9, "x a b y"].runs == [(1, 8, 2)]
    assert got[10, "a a a a a"].runs == [] and got[None, "b"].n_words == 6
    assert got[1, ""].n_words == got[2, ""].n_words == got[3, ""].n_words == 0
    assert len(runs.find_runs(documents(spark, rows)).collect()) == len(rows)
    assert runs.find_runs(documents(spark, rows).limit(0)).collect() == []


def test_only_blanks_of_ascii_part_words(spark):
    rows = [(1, "a a a a\ta a\x0ba a\x0ca a\ra a\na a\x1c")]
    row = runs.find_runs(documents(spark, rows)).first()
    assert row.n_words == 7 and row.runs == [(0, 6, 1)]


def digested(doc_id: int | None, text: str | None) -> tuple:
    """A row of the query, by the plain way."""
    words = (text or "").encode().split()
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 == 0 and words:
        begin = h // 10 % len(words)
        period = 1 + (len(words) - begin) // (3 + h // 10 % 8)
        words = [word if at < begin else words[begin + (at - begin) % period] for at, word in enumerate(words)]
    found = plain(words)
    best = max(found, key=lambda run: (Fraction(run[1], run[2]), -run[0], -run[2]), default=(None,) * 3)
    gone = {at for start, length, period in found for at in range(start + period, start + length)}
    listed = "".join(f"{start},{length},{period}\n" for start, length, period in found)
    rest = b" ".join(word for at, word in enumerate(words) if at not in gone)
    milli = 1000 * best[1] // best[2] if found else None
    return (doc_id, len(found), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(rest).hexdigest())


def test_query_on_the_given_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, queries.op12_runs(spark, sf_dir).collect()))
    assert got == sorted(digested(*row) for row in docs)
    assert sum(row[1] for row in got) > 50


def test_query_on_odd_rows(spark, tmp_path):
    rows = [*ODD_ROWS, *((at, prose(at, 40 + at)) for at in range(20, 120)), (None, "a b " * 30)]
    documents(spark, rows, clash=False).write.parquet(str(tmp_path / "documents.parquet"))
    got = map(tuple, queries.op12_runs(spark, str(tmp_path)).collect())
    assert sorted(got, key=repr) == sorted((digested(*row) for row in rows), key=repr)
