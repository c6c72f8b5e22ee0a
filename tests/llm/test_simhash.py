from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from quotelake.llm import simhash
from quotelake.llm.common import components
from tests.llm.helpers import ODD_ROWS, documents, prose


def brute_fingerprint(text):
    words = [w for w in (text or "").encode().replace(b"\x0b", b" ").lower().split() if w]
    if not words:
        return 0
    shingles = [b" ".join(words[at : at + 4]) for at in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_components(values, max_bits):
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    for a, b in combinations(sorted(parent), 2):
        if (a ^ b).bit_count() <= max_bits:
            parent[find(b)] = find(a)
    return {v: find(v) for v in parent}


def near_prints(seed, count=250):
    pick = random.Random(seed)
    values = [pick.getrandbits(64) for _ in range(12)]
    while len(values) < count:
        value = pick.choice(values)
        for _ in range(pick.randint(1, 7)):
            value ^= 1 << pick.randrange(64)
        values.append(value)
    return values


def signed(value):
    return value - (1 << 64) if value >> 63 else value


@pytest.mark.parametrize("bucket_rows", [2000, 2, 0])
@pytest.mark.parametrize("max_bits", [4, 3, 1, 0])
def test_links_give_the_components_of_brute_force(spark, max_bits, bucket_rows):
    values = near_prints(max_bits)
    prints = spark.createDataFrame([(signed(v),) for v in set(values)], "fp long")
    links = simhash.close_pairs(prints, max_bits, bucket_rows).collect()
    want = brute_components(values, max_bits)
    for row in links:
        assert want[row.a % (1 << 64)] == want[row.b % (1 << 64)]
    got = {v: v for v in values}

    def find(v):
        while got[v] != v:
            v = got[v]
        return v

    for row in links:
        got[find(row.a % (1 << 64))] = find(row.b % (1 << 64))
    assert len({find(v) for v in values}) == len(set(want.values()))


def test_every_close_pair_shares_a_key():
    values = np.array(near_prints(77, 600), np.uint64)
    (index_rows, index_keys), (probe_rows, probe_keys) = simhash.fuzzy_keys(values)
    index = {}
    for row, key in zip(index_rows.tolist(), index_keys.tolist()):
        index.setdefault(key, set()).add(row)
    met = {(a, b) for a, key in zip(probe_rows.tolist(), probe_keys.tolist()) for b in index.get(key, ())}
    for a, b in combinations(range(len(values)), 2):
        if int(values[a] ^ values[b]).bit_count() <= 4:
            assert (a, b) in met and (b, a) in met


def test_golay_code_is_perfect():
    table, filled = simhash.decoding_table()
    light = np.bitwise_count(table[:, 0].astype(np.uint64))
    assert light.max() == 3 and (filled[light < 3] == 1).all() and (filled[light == 3] == 6).all()


@pytest.mark.parametrize("text", [None, "", " \t", "One", "one two three", "A b C d", "a b c d e f" * 9, "É é x\u0085y z\x1cw", prose(1, 400)])
def test_fingerprints(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_components_of_chains_and_stars(spark):
    pick = random.Random(8)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (300, 299)]
    edges += [(pick.randrange(400, 500), pick.randrange(400, 500)) for _ in range(60)]
    got = {row.node: row.root for row in components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    parent = {v: v for edge in edges for v in edge}
    for _ in parent:
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    alone = {7: 7}
    assert {**alone, **got} == {**parent, **got} and got == {v: p for v, p in parent.items() if v in got}
    assert components(spark.createDataFrame([], "a long, b long"), "test").collect() == []


def test_documents(spark):
    pick = random.Random(5)
    rows = list(ODD_ROWS)
    for i in range(20):
        words = prose(50 + i, 300).split()
        for copy in range(4):
            changed = list(words)
            changed[pick.randrange(300)] = f"new{copy}"
            rows.append((1000 - 10 * i - copy, " ".join(changed)))
    docs = documents(spark, rows)
    found = simhash.near_copies(docs).collect()
    assert len(found) == len(rows)
    prints = {(i, t): brute_fingerprint(t) for i, t in rows}
    roots = brute_components(prints.values(), 4)
    smallest = {}
    for (i, _), value in prints.items():
        if i is not None:
            smallest[roots[value]] = min(i, smallest.get(roots[value], i))
    want = sorted((str(i), f"{brute_fingerprint(t):016x}", str(smallest.get(roots[brute_fingerprint(t)]))) for i, t in rows)
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in found) == want

    stay = simhash.one_of_each(docs)
    assert stay.columns == docs.columns
    kept = [row.doc_id for row in stay.collect()]
    assert len(kept) == len(set(kept))
    heads = {i for i, t in rows if smallest.get(roots[brute_fingerprint(t)]) == i}
    assert set(kept) == heads


def test_one_document_of_each_group_not_of_each_id(spark):
    one, two, three, four = (prose(200 + i, 300) for i in range(4))
    rows = [(None, one), (None, two), (None, two + " more"), (None, two), (7, three), (7, four), (7, four), (3, four + " more"), (None, three)]
    prints = {t: brute_fingerprint(t) for _, t in rows}
    roots = brute_components(prints.values(), 4)
    assert len(set(roots.values())) == 4
    stay = [(row.doc_id, row.text) for row in simhash.one_of_each(documents(spark, rows)).collect()]
    assert sorted(roots[prints[t]] for _, t in stay) == sorted(set(roots.values()))
    assert set(stay) <= set(rows) and (None, one) in stay and (7, three) in stay and (3, four + " more") in stay


def test_unrelated_texts_without_ids_all_stay(spark):
    texts = [prose(300 + i, 200) for i in range(20)]
    docs = documents(spark, [(None, t) for t in texts] + [(5, t) for t in texts[:3]])
    stay = [(row.doc_id, row.text) for row in simhash.one_of_each(docs).collect()]
    assert sorted(t for _, t in stay) == sorted(texts) and sum(i == 5 for i, _ in stay) == 3


def test_empty_table(spark):
    docs = documents(spark, ODD_ROWS).limit(0)
    assert simhash.near_copies(docs).collect() == [] and simhash.one_of_each(docs).collect() == []
