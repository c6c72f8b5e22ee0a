from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from quotelake.llm import quality
from tests.llm.helpers import ODD_ROWS, documents, prose


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[at : at + 8]) for at in range(len(words) - 7)]
    counts = Counter(windows)
    inside = {at + k for at, window in enumerate(windows) if counts[window] > 1 for k in range(8)}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    n = len(words)
    return (
        n,
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        repeated,
        len(inside),
        n < 20 or 100 * len(inside) > 30 * n,
    )


def random_texts():
    pick = random.Random(1)
    for _ in range(60):
        few = [pick.choice(["a", "b", "ß", "x y", "#|<", "\x1c"]) for _ in range(3)]
        yield "".join(pick.choice(few) + pick.choice([" ", "\n", "\t", "  ", "\x0b"]) for _ in range(pick.randint(0, 80)))
    block = prose(1, 30)
    yield from (block + "\n" + block, block + " z " + block, prose(2, 500))


def test_measures_are_those_of_brute_force(spark):
    rows = list(enumerate([*(text for _, text, *_ in ODD_ROWS), *random_texts()]))
    got = quality.score_quality(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = {row.doc_id: row for row in got}
    for doc_id, text in rows:
        row = by_id[doc_id]
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed) == brute(text)
        assert not (row.base_failed and row.kept)


def test_js_distance():
    p, q = np.array([1.0, 3.0, 0.0]), np.array([0.0, 1.0, 1.0])
    a, b = p / p.sum(), q / q.sum()
    m = (a + b) / 2
    parts = [sum(x * math.log2(x / y) for x, y in zip(side, m) if x) for side in (a, b)]
    assert quality.js_distance(p, q) == pytest.approx(math.sqrt(sum(parts) / 2))
    assert quality.js_distance(p, p) == 0
    assert quality.js_distance(p, np.zeros(3)) == 1


def test_unlike_texts_go_and_usual_ones_stay(spark):
    usual = [(i, prose(i, 200), "xx") for i in range(120)]
    shout = [(500, prose(500, 200).upper() + "!!!", "xx"), (501, " | ".join(f"q{i}z" for i in range(200)), "xx")]
    short = [(600, "SHORT " * 5 + prose(7, 20), "xx"), (601, prose(8, 200), None), (602, prose(9, 200), "never seen")]
    rows = documents(spark, usual + shout + short)
    kept = {row.doc_id: row.kept for row in quality.score_quality(rows).collect()}
    assert all(kept[i] for i, *_ in usual) and not kept[500] and not kept[501]
    assert kept[600] and kept[601] and kept[602]
    stays = quality.good_documents(rows)
    assert stays.columns == rows.columns
    assert sorted(row.doc_id for row in stays.collect()) == sorted(i for i, is_kept in kept.items() if is_kept)


def test_odd_rows_and_empty_table(spark):
    rows = documents(spark, ODD_ROWS)
    got = quality.score_quality(rows).collect()
    assert len(got) == len(ODD_ROWS)
    assert sum(row.doc_id is None for row in got) == 1 and sum(row.doc_id == 5 for row in got) == 2
    assert quality.score_quality(rows.limit(0)).collect() == []
    assert quality.good_documents(rows.limit(0)).collect() == []


def test_low_quality_labels_are_told(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = quality.score_quality(docs).where("not base_failed").join(labels, "doc_id").collect()
    good = [row.kept for row in rows if row.quality == 1]
    bad = [row.kept for row in rows if row.quality == 0]
    assert sum(good) / len(good) > 0.99 and sum(bad) / len(bad) < 0.2


@pytest.mark.parametrize("letters", ["абвгдежзиклмнопрстуф", "กขคงจฉชซดตถทนบปผพมยร", "的一是不了在人有我他这个们中来上大为和国"])
def test_noise_of_other_scripts_is_told_from_prose(spark, letters):
    pick = random.Random(5)
    words = ["".join(pick.choice(letters) for _ in range(pick.randint(4, 9))) for _ in range(60)]
    shares = [1 / (at + 1) for at in range(len(words))]
    rows = [(at, " ".join(pick.choices(words, shares, k=120)), "xx") for at in range(120)]
    rows += [(500 + at, " ".join("".join(pick.choice(letters) for _ in range(5)) for _ in range(120)), "xx") for at in range(3)]
    got = {row.doc_id: row for row in quality.score_quality(documents(spark, rows)).collect()}
    assert all(got[500 + at].word_distance > 0.5 and not got[500 + at].kept for at in range(3))
    assert sum(got[at].kept for at in range(120)) > 115


def test_counts_handed_on_early_are_the_same(spark, monkeypatch):
    docs = documents(spark, [(at, prose(at, 50), "en") for at in range(40)])
    whole = sorted(map(tuple, quality.histograms(docs).collect()))
    monkeypatch.setattr(quality, "HELD_WORDS", 3)
    assert sorted(map(tuple, quality.histograms(docs).collect())) == whole


def test_stage_and_query_treat_a_null_language_alike(spark, monkeypatch):
    monkeypatch.setattr(quality, "REFERENCE_WORDS", 100)
    rows = [(at, "one two three four " * 20, "") for at in range(20)] + [(100 + at, prose(at, 80), "en") for at in range(40)]
    rows += [(200, prose(99, 80), None)]
    docs = documents(spark, rows)
    kept = {row.doc_id for row in quality.score_quality(docs).collect() if row.kept}
    assert {row.doc_id for row in quality.good_documents(docs).collect()} == kept and 200 in kept
