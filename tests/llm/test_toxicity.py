from __future__ import annotations

import random
from itertools import combinations
from math import sqrt
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotelake.llm import toxicity
from quotelake.llm.common import in_fold
from tests.llm.helpers import ODD_ROWS, documents, prose

INSULTS = ("grumblok", "snarvex", "pimdork")


def brute_kernel(one: str, other: str) -> float:
    def features(text):
        found = {}
        for places in combinations(range(len(text)), toxicity.ORDER):
            key = "".join(text[at] for at in places)
            weight = toxicity.DECAY ** (places[-1] - places[0] + 1 - toxicity.ORDER)
            found[key] = found.get(key, 0) + weight
        return found

    a, b = features(one), features(other)
    dot = lambda x, y: sum(w * y.get(k, 0) for k, w in x.items())
    if not a or not b:
        return 0.0
    return dot(a, b) / sqrt(dot(a, a) * dot(b, b))


def test_kernel_is_that_of_brute_force():
    pick = random.Random(2)
    words = ["".join(pick.choice("abcd") for _ in range(pick.randint(4, toxicity.WINDOW))) for _ in range(30)]
    rows = np.concatenate([toxicity.windows(word) for word in words])
    got = toxicity.Landmarks(rows[:10]).kernel(rows)
    want = [[brute_kernel(word, mark) for mark in words[:10]] for word in words]
    assert np.allclose(got, want, atol=1e-5)


def labelled(spark, toxic_share=5):
    pick = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        words = prose(i, 40).split()
        if i % toxic_share == 0:
            for _ in range(3):
                words.insert(pick.randrange(len(words)), pick.choice(INSULTS))
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % toxic_share == 0), 1))
    hidden = ["grumxblok", "g.r.u.m.b.l.o.k", "snarrvex", "s n a r v e x", "P1mdork!", "pimdork"]
    rows += [(1000 + at, f"{prose(at, 20)} {word} {prose(at + 9, 20)}") for at, word in enumerate(hidden)]
    return documents(spark, [*rows, *[(2000 + at, row[1]) for at, row in enumerate(ODD_ROWS)], *ODD_ROWS[5:7]]), spark.createDataFrame(labels, "doc_id long, toxic int, quality int")


def test_held_out_and_hidden_insults(spark):
    docs, labels = labelled(spark)
    rows = toxicity.score_toxicity(docs, labels).collect()
    assert len(rows) == docs.count()
    scores = {row.doc_id: row for row in rows}
    assert all(0 <= row.score <= 1 and row.predicted == int(row.score >= 0.5) for row in rows)
    held = [row for row in rows if row.held_out and row.doc_id is not None and row.doc_id < 600]
    assert len(held) > 60
    assert sum(row.predicted == int(row.doc_id % 5 == 0) for row in held) / len(held) > 0.97
    assert all(scores[1000 + at].predicted == 1 for at in range(6))
    assert scores[2000].score == scores[2001].score == min(row.score for row in rows)


def test_insults_anywhere_in_compounds(spark):
    """Insults that never begin a word, each in a few of some 400 toxic training texts."""
    pick = random.Random(9)
    insults = ["zorvik", "qualdup", "wimpfex", "drozzel", "ghablik", "yuxtron", "vopplin", "kraddix", "jumfass", "zebbrok", "hoddrix", "pluvvag"]
    rows, labels = [], []
    for i in range(1200):
        words = prose(i, 30).split()
        if i % 2 == 0:
            words.insert(pick.randrange(len(words)), pick.choice(["ba", "mo", "tu"]) + pick.choice(insults) + pick.choice(["", "er", "lan"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 2 == 0)))
    docs = documents(spark, rows)
    got = toxicity.score_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    held = [row for row in got if row.held_out]
    caught = [row.predicted for row in held if row.doc_id % 2 == 0]
    assert sum(caught) / len(caught) > 0.9
    assert sum(row.predicted for row in held if row.doc_id % 2) / len(held) < 0.03


def test_three_letters_are_enough(spark):
    rows = [(i, " ".join([*prose(i, 20).split(), *(["zug"] if i % 3 == 0 else [])])) for i in range(300)]
    docs, labels = documents(spark, rows), spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int")
    held = [row for row in toxicity.score_toxicity(docs, labels).collect() if row.held_out]
    assert sum(row.predicted == int(row.doc_id % 3 == 0) for row in held) / len(held) > 0.95


def test_small_tables_take_the_same_path(spark):
    tables = {sf: Path("/root/testdata", sf) for sf in ("sf0.001", "sf0.01")}
    for folder in tables.values():
        docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
        rows = toxicity.score_toxicity(docs, labels).collect()
        assert len(rows) == docs.count() and len({row.score for row in rows}) > 50


def test_decisions_are_those_of_brute_force(spark):
    docs, labels = labelled(spark)
    held_out = in_fold(F.col("doc_id"), 5, 0)
    machine = toxicity.fit(docs, labels, ~held_out)
    marks = ["".join(chr(96 + code) for code in row if code) for row in machine.landmarks]
    assert all(3 <= len(mark) <= 8 for mark in marks)
    texts = {row.doc_id: row.text for row in docs.where("doc_id between 990 and 1005 or doc_id < 8").collect()}
    got = {row.doc_id: row.score for row in toxicity.score_toxicity(docs, labels).collect()}
    for doc_id, text in texts.items():
        nearest = np.zeros(len(marks))
        for word in toxicity.words_of(text):
            letters = "".join(c for c in word.lower().translate(toxicity.LOOKALIKES) if c.isalpha())
            for at in range(max(1, len(letters) - toxicity.WINDOW + 1)):
                window = letters[at : at + toxicity.WINDOW]
                if len(window) >= toxicity.ORDER:
                    near = np.array([brute_kernel(window, mark) for mark in marks])
                    nearest = np.maximum(nearest, np.where(near > toxicity.FAR, near, 0))
        decision = max(nearest @ machine.weights + machine.bias, machine.least) if nearest.any() else machine.least
        assert got[doc_id] == pytest.approx(1 / (1 + np.exp(-(machine.slope * decision + machine.shift))), abs=1e-3)


def test_held_out_labels_are_not_learned(spark):
    docs, labels = labelled(spark)
    held = in_fold(F.col("doc_id"), 5, 0)
    other = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    sides = [{r.doc_id: r.score for r in toxicity.score_toxicity(docs, each).collect()} for each in (labels, other)]
    assert sides[0] == pytest.approx(sides[1])


@pytest.mark.parametrize("toxic", [None, 0, 1])
def test_without_both_labels(spark, toxic):
    docs = documents(spark, ODD_ROWS)
    labels = spark.createDataFrame([(i, toxic) for i in range(2, 7)], "doc_id long, toxic int")
    scores = {round(row.score, 6) for row in toxicity.score_toxicity(docs, labels).collect()}
    assert len(scores) == 1 and 0 <= min(scores) <= 1


def test_empty_tables(spark):
    docs, labels = labelled(spark)
    assert toxicity.score_toxicity(docs.limit(0), labels).collect() == []
    assert len(toxicity.score_toxicity(docs.limit(5), labels.limit(0)).collect()) == 5
