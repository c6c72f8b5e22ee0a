from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from quotelake.llm import decontaminate as d
from tests.llm.helpers import CLASHING, ODD_ROWS, WORDS, documents, prose


def index_of(texts, corpus, min_score=d.MIN_SCORE):
    items = [d.Item(i, *map(d.plain_words, d.split_item(text))) for i, text in enumerate(texts)]
    items = [item for item in items if len(item.words()) >= d.SHINGLE]
    words = {word for item in items for word in item.words()}
    counts = Counter(word for text in corpus for word in words.intersection(d.plain_words(text)))
    return d.ItemIndex(items, counts, len(corpus), min_score)


def test_search_finds_all_above_the_threshold():
    pick = random.Random(6)
    items = [prose(seed, pick.randint(6, 50)) for seed in range(70)]
    corpus = []
    for seed in range(60):
        words = prose(1000 + seed, pick.randint(0, 400)).split()
        part = pick.choice(items).split()
        at = pick.randint(0, len(words))
        corpus.append(" ".join(words[:at] + part[: pick.randint(0, len(part))] + words[at:]))
    index = index_of(items, corpus, 0.7)
    below = 0
    for text in corpus:
        words = d.plain_words(text)
        let_through = {start: terms for start, _, terms in index.passages(words)}
        for start in range(0, max(1, len(words) - index.half), index.half):
            known = {index.vocabulary[w] for w in words[start : start + 2 * index.half] if w in index.vocabulary}
            scores = np.zeros(len(index.items))
            for term in known:
                scores[index.places[term]] += index.impacts[term]
            want = np.flatnonzero(scores >= index.min_score + 1e-9).tolist()
            terms = let_through.get(start, np.zeros(0, int))
            got = dict(index._wand(terms, index._open_blocks(terms))) if len(terms) else {}
            assert set(want) <= set(got)
            assert all(abs(scores[place] - score) < 1e-9 for place, score in got.items())
            below += len(scores) - len(want)
    assert below


def test_planted_items_are_found_and_others_not(spark):
    items = [(i, f"{prose(50 + i, 30)}\nzq{i} answer of item number{i} here") for i in range(40)]
    items += [(100, None), (101, "too short"), (102, items[0][1]), (None, prose(99, 20) + " nameless item")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = [(i, prose(5000 + i, 200)) for i in range(50)]
    rows += [(1000 + i, f"{prose(i, 70 * i)} {items[i][1].upper()} {prose(i + 1, 90)}") for i in range(10)]
    question = items[5][1].split("\n")[0]
    rows += [(2000, f"{prose(3, 50)} {items[5][1].rsplit(chr(10), 1)[0]} {prose(4, 50)}"), (2001, question)]
    docs = documents(spark, rows + ODD_ROWS)
    found = {(row.doc_id, row.item_id) for row in d.find_leaks(docs, d.as_items(benchmark)).collect()}
    assert found == {(1000 + i, i) for i in range(10)} | {(1000, 102)}
    clean = d.clean_documents(docs, d.as_items(benchmark))
    assert clean.columns == docs.columns
    assert clean.count() == docs.count() - 10


def test_shards_of_the_index_find_the_same(spark, monkeypatch):
    benchmark = spark.createDataFrame([(i, f"{prose(50 + i, 30)} zq{i} end") for i in range(20)], "item_id long, text string")
    rows = documents(spark, [(i, prose(50 + i, 30) + f" zq{i} end") for i in range(12)])
    whole = {tuple(r) for r in d.find_leaks(rows, d.as_items(benchmark)).select("doc_id", "item_id").collect()}
    monkeypatch.setattr(d, "SHARD_CHARS", 1500)
    parts = {tuple(r) for r in d.find_leaks(rows, d.as_items(benchmark)).select("doc_id", "item_id").collect()}
    assert whole == parts and len(whole) == 12


def test_empty_tables_and_clashing_names(spark):
    benchmark = spark.createDataFrame([(1, prose(1, 30), "x")], f"item_id long, text string, {CLASHING[0]} string")
    rows = documents(spark, [(1, prose(1, 30)), (1, prose(1, 30)), (None, prose(1, 30))])
    assert len(d.find_leaks(rows, d.as_items(benchmark)).collect()) == 3
    assert d.find_leaks(rows.limit(0), d.as_items(benchmark)).collect() == []
    assert d.find_leaks(rows, d.as_items(benchmark.limit(0))).collect() == []
    assert d.clean_documents(rows, d.as_items(benchmark.limit(0))).count() == 3


def test_split_and_overlap():
    assert d.split_item("What is it?\nA cat.") == ("What is it?", "\nA cat.")
    assert d.split_item("What is it? A cat.") == ("What is it? ", "A cat.")
    words = [word.encode() for word in WORDS]
    assert d.overlap(words[:3], words) == 1 and d.overlap(words[2::-1], words) == 0 and d.overlap([], words) == 1
    assert d.overlap(words[:10], words[:8]) == pytest.approx(4 / 6)
