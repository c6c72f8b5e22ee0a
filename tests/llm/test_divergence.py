from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from quotelake.llm import divergence
from tests.llm.helpers import ODD_ROWS, WORDS, documents, prose

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def audited(rows: list[tuple], min_docs: int = 3, top: int = 200, scale: int = divergence.SCALE) -> list[tuple]:
    """All of it by itself, from rows of (text, lang, source)."""
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(SMALL))) for text, lang, source in rows]
    found = []
    for lang in {doc[0] for doc in docs}:
        own = [doc for doc in docs if doc[0] == lang]
        among = Counter(term for _, _, terms in own for term in set(terms))
        kept = sorted((term for term, many in among.items() if many >= min_docs), key=lambda term: term.encode())
        counts = {source: Counter() for _, source, _ in own}
        whole: Counter = Counter()
        for _, source, terms in own:
            told = [term for term in terms if among[term] >= min_docs]
            counts[source].update(told)
            whole.update(told)

        def share(many: Counter) -> dict[str, int]:
            below = sum(many.values()) + len(kept)
            return {term: 1 + scale * (many[term] + 1) // below for term in kept}

        p, q = {source: share(many) for source, many in counts.items()}, share(whole)
        for source in counts:
            pairs = [(-sum((p[source][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode(), o) for o in counts if o != source]
            terms = [(-((p[source][t] - q[t]) ** 2 // q[t]), t.encode(), t) for t in kept if counts[source][t] and p[source][t] > q[t]]
            for part, ranked in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                found += [(lang, source, part, item, -value, rank) for rank, (value, _, item) in enumerate(ranked, 1)]
    return sorted(found)


def made(spark, rows: list[tuple], clash: bool = True):
    docs = documents(spark, [(at, text, lang) for at, (text, lang, _) in enumerate(rows)], clash)
    sources = spark.createDataFrame([(at, source) for at, (*_, source) in enumerate(rows)], "key long, from_source string")
    return docs.drop("source").join(sources, docs.doc_id == sources.key).withColumnRenamed("from_source", "source")


def corpus() -> list[tuple]:
    rows = [(prose(at, 5 + at % 90), ("en", "de", None)[at % 3], ("a", "b", "c", None, "é")[at % 5]) for at in range(90)]
    rows += [(text, "en", "a") for _, text, *_ in ODD_ROWS]
    rows += [("É é ÉÉ x_y a1b DON'T don't 中文 ß " * 3, "en", "b")] * 4
    rows += [("12 34 !!", "zz", "a"), (None, "zz", "b"), ("once only", "zz", "c"), ("alone in its language", "yy", "a")]
    return rows


def test_same_as_every_term_by_itself(spark):
    rows = corpus()
    got = sorted(map(tuple, divergence.audit_sources(made(spark, rows)).collect()))
    assert got == audited(rows)
    # Languages without kept terms: pairs of value 0 by name, and no terms.
    zz = [row for row in got if row[0] == "zz"]
    assert [row[2:] for row in zz if row[1] == "a"] == [("pair", "b", 0, 1), ("pair", "c", 0, 2)]
    assert not [row for row in got if row[0] == "yy"]


def test_other_parameters_and_ties_in_byte_order(spark):
    # Many terms share one cell: ranks go by bytes, cut in the midst of equal values.
    words = sorted({a + b for a in WORDS for b in WORDS} | {"é" + w for w in WORDS})[:400]
    rows = [(" ".join(words), "en", "a")] * 3 + [(" ".join(words[::2]) + " other" * 9, "en", "b")] * 2
    for top in (7, 200, 1000):
        got = sorted(map(tuple, divergence.audit_sources(made(spark, rows), 2, top, 10**6).collect()))
        assert got == audited(rows, 2, top, 10**6)
        assert max(row[5] for row in got if row[2] == "term") <= top


def test_texts_in_chunks_and_pieces_count_the_same(spark, monkeypatch):
    rows = corpus()
    want = audited(rows)
    monkeypatch.setattr(divergence, "CHUNK_BYTES", 200)
    monkeypatch.setattr(divergence, "ROWS_OUT", 3)
    monkeypatch.setattr(divergence, "PAIR_ROWS", 5)
    monkeypatch.setattr(divergence, "HELD_SUMS", 4)
    assert sorted(map(tuple, divergence.audit_sources(made(spark, rows)).collect())) == want


def test_empty_table_and_the_session_is_as_before(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    docs = made(spark, [("some text", "en", "a")])
    assert divergence.audit_sources(docs.limit(0)).collect() == []
    assert divergence.audit_sources(docs.withColumn("text", F.lit(None).cast("string"))).collect() == []
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_terms_are_those_of_the_pattern():
    texts = ["Ab,é中x\x00y Z", "", "q", "é"]
    raw = [text.encode() for text in texts]
    starts = np.cumsum([0, *map(len, raw)])[:-1]
    found, _ = divergence.find_terms(np.frombuffer(b"".join(raw), np.uint8), starts)
    assert found.to_pylist() == [term for text in texts for term in TERM.findall(text.translate(SMALL))]
