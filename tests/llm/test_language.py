from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from quotelake.llm import language
from quotelake.llm.common import in_fold
from tests.llm.helpers import ODD_ROWS, documents


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = language.predict_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [row for row in rows if row.held_out]
    assert len(rows) == docs.count() and len(held) > 200
    assert sum(row.lang == row.lang_pred for row in held) / len(held) > 0.99
    assert all(0 <= row.score <= 1 for row in rows)


def test_held_out_rows_are_not_learned(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    other = docs.withColumn("lang", F.when(in_fold(F.col("doc_id"), 4, 2), "zz").otherwise(F.col("lang")))
    sides = [sorted(map(tuple, language.predict_languages(each).collect())) for each in (docs, other)]
    assert sides[0] == sides[1]


def test_odd_rows_and_empty_tables(spark):
    rows = [(100 + i, "the cat sat on the mat " * 3, "en") for i in range(8)]
    rows += [(200 + i, "der Hund und die Katze und das Haus", "de") for i in range(8)]
    rows += [(300, "1234 !!", "en"), (301, None, "de"), (302, "the mat", None)]
    docs = documents(spark, rows + ODD_ROWS)
    got = language.predict_languages(docs).collect()
    assert len(got) == len(rows) + len(ODD_ROWS)
    by_id = {row.doc_id: (row.lang_pred, row.score) for row in got}
    assert by_id[300] == by_id[301] == by_id[1] == by_id[2] == by_id[3] == ("und", 0.0)
    assert by_id[302][0] == "en" and by_id[105][0] == "en" and by_id[205][0] == "de"
    assert language.predict_languages(docs.limit(0)).collect() == []
    unlabelled = language.predict_languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(row.lang_pred, row.score) for row in unlabelled} == {("und", 0.0)}


def test_profile_is_the_bundle_of_bound_vectors():
    profiles = language.Profiles()
    text = "Ab, abé!"
    want = np.zeros(language.DIMENSIONS)
    padded = " ab abé "
    codes = [0 if c == " " else ord(c) for c in padded]
    for at in range(len(codes) - 2):
        vectors = [np.roll(profiles._letter(code), 2 - k) for k, code in enumerate(codes[at : at + 3])]
        want += vectors[0].astype(int) * vectors[1] * vectors[2]
    assert (profiles.bundle([text])[0] == want).all()


def test_pieces_of_a_long_text_count_as_one(monkeypatch):
    text = "some words, 12 and ümlauts  " * 40
    whole = language.ngram_counts(text)
    monkeypatch.setattr(language, "PIECE", 7)
    parts = language.ngram_counts(text)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def test_many_null_or_equal_ids_are_learned_and_all_letters_count(spark):
    rows = [(None, "the cat sat on the mat", "en")] * 40 + [(None, f"the dog {at} sat down", "en") for at in range(40)]
    rows += [(7, f"der Hund {at} und die Katze", "de") for at in range(40)]
    rows += [(at, "".join(map(chr, range(0x30000 + at, 0x30020 + at))), "zz") for at in range(100, 120)]
    docs = documents(spark, rows)
    models = language.prototypes(docs, F.lit(True), per_language=30)
    assert set(models) == {"en", "de", "zz"}
    got = language.identify(docs, models).collect()
    assert all(row.lang_pred == "zz" for row in got if row.doc_id is not None and row.doc_id >= 100)


def test_rare_languages_are_learned_however_many_there_are(spark):
    pick = [chr(0x4E00 + at) for at in range(1400)]
    rows = [(at, " ".join(pick[2 * (at // 3) : 2 * (at // 3) + 2]) * 3, f"l{at // 3:03}") for at in range(1800)]
    models = language.prototypes(documents(spark, rows, clash=False), F.lit(True))
    assert len(models) == 600
