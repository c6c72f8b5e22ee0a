"""Near copies by 64-bit fingerprints, found with a Golay-code fuzzy hash.

A fingerprint is cut in three segments, each decoded with the binary Golay code
(23, 12): every 23-bit word lies within 3 bits of exactly one codeword, and has
one to six codewords within 4 bits. Two words that differ in at most two bits
share one of these codewords; for one bit, the nearest codeword of either is
among those of the other. If two fingerprints differ in at most four bits, the
two segments with the fewest errors have at most (1, 1) or exactly (0, 2), and
in the latter case the third has 2 as well. So one key per pair of segments
(nearest codewords) on the index side and all codewords on the probe side find
the former; an equal segment with the codewords of the next one finds the latter.

Nulls and texts without words have fingerprint zero and are linked like others.
Repeated rows share a fingerprint; each keeps its row in the result. Null ids
stay in the result and take no part in the smallest id of a group, whose
component is null if it has null ids alone. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import components, once, settle, small_batches

SHINGLE_WORDS = 4
MAX_BITS = 4
HASH_SEED = 42
# Segments of the fingerprint as (lowest bit, number of bits).
SEGMENTS = ((42, 22), (21, 21), (0, 21))
# Buckets with more index rows are linked through midpoints instead of pairs.
BUCKET_ROWS = 2000
# Two hashes of id and text tell the documents apart: equal only for repeated rows.
ROW_KEYS = ("_simhash_row_a", "_simhash_row_b")

# Generator polynomial of the binary Golay code (23, 12), a fixed value.
GOLAY_POLYNOMIAL = 0b110001110101


def fingerprint(text: str | None, words_each: int = SHINGLE_WORDS) -> int:
    """SimHash over XXH64 of the shingles of the text, ASCII lower-cased."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda done, size: done + size + 1))
    starts = [0, *(end + 1 for end in ends)]
    last = ends[min(words_each, len(words)) - 1 :]
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a:b], HASH_SEED) for a, b in zip(starts, last)])
    bits = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(bits), 1 << 16):
        counts += np.unpackbits(bits[at : at + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(bits)).tobytes(), "big")


def fingerprints(documents: DataFrame, words_each: int = SHINGLE_WORDS, also: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, fp`` with the fingerprint as a signed long, one row per document.

    The columns ``also``, longs, go along.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py(), words_each) for t in batch.column(1)]
            signed = np.array(prints, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(signed), *batch.columns[2:]], names=["doc_id", "fp", *also]
            )

    small_batches(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *also)
    return rows.mapInArrow(run, ", ".join(f"{name} long" for name in ("doc_id", "fp", *also)))


def syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator polynomial."""
    rest = words.astype(np.int64)
    for bit in range(22, 10, -1):
        rest ^= np.where(rest >> bit & 1, GOLAY_POLYNOMIAL << (bit - 11), 0)
    return rest


@once
def decoding_table() -> tuple[np.ndarray, np.ndarray]:
    """Error patterns of up to 4 bits by syndrome, lightest first; how many."""
    patterns = [
        sum(1 << bit for bit in bits) for size in range(5) for bits in combinations(range(23), size)
    ]
    found = syndromes(np.array(patterns))
    table, filled = np.zeros((2048, 6), np.int64), np.zeros(2048, np.int64)
    for pattern, syndrome in zip(patterns, found.tolist()):
        table[syndrome, filled[syndrome]] = pattern
        filled[syndrome] += 1
    return table, filled


def codewords(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the codewords within 4 bits, nearest first, and how many."""
    table, filled = decoding_table()
    syndrome = syndromes(words)
    return (words[:, None] ^ table[syndrome]) >> 11, filled[syndrome]


def fuzzy_keys(prints: np.ndarray) -> tuple[tuple, tuple]:
    """(rows, keys) of the index and of the probe side, for unsigned fingerprints."""
    values = [(prints >> np.uint64(low)).astype(np.int64) & ((1 << size) - 1) for low, size in SEGMENTS]
    near = [codewords(value) for value in values]
    place = np.arange(len(prints))
    index_rows, index_keys, probe_rows, probe_keys = [], [], [], []
    for kind, (a, b) in enumerate(((0, 1), (0, 2), (1, 2))):
        (codes_a, many_a), (codes_b, many_b) = near[a], near[b]
        head = kind << 40
        index_rows.append(place)
        index_keys.append(head | codes_a[:, 0] << 12 | codes_b[:, 0])
        for i in range(6):
            for j in range(6):
                use = (i < many_a) & (j < many_b)
                probe_rows.append(place[use])
                probe_keys.append(head | codes_a[use, i] << 12 | codes_b[use, j])
    for kind in range(3):
        codes, many = near[(kind + 1) % 3]
        head = (kind + 3) << 40
        for i in range(6):
            use = i < many
            keys = head | values[kind][use] << 12 | codes[use, i]
            for rows, out in ((index_rows, index_keys), (probe_rows, probe_keys)):
                rows.append(place[use])
                out.append(keys)
    return (
        (np.concatenate(index_rows), np.concatenate(index_keys)),
        (np.concatenate(probe_rows), np.concatenate(probe_keys)),
    )


def _keyed(prints: DataFrame, side: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            rows, keys = fuzzy_keys(values.view(np.uint64))[side]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(values[rows])], names=["bucket", "fp"]
            )

    return prints.mapInArrow(run, "bucket long, fp long")


def close_pairs(prints: DataFrame, max_bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links ``a, b`` between the distinct fingerprints ``fp``, as longs.

    Every pair at ``max_bits`` or less is in one component of these links, and
    every link is between fingerprints that close or joined by such ones. A probe
    meets at most ``bucket_rows`` index rows; larger buckets are linked exactly
    through the values half way between their members, without pairs.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the keys hold for at most {MAX_BITS} bits")
    index, probe = _keyed(prints, 0), _keyed(prints, 1)
    sizes = index.groupBy("bucket").count().where(F.col("count") > bucket_rows)
    full = settle(sizes.select("bucket"), "simhash-full")
    left = probe.withColumnRenamed("fp", "a")
    right = index.withColumnRenamed("fp", "b")
    crowded = not full.isEmpty()
    if crowded:
        left = left.join(full, "bucket", "left_anti")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    # The distance is part of the join, so that other pairs never leave it.
    links = left.join(right, (left.bucket == right.bucket) & (F.col("a") != F.col("b")) & near)
    links = links.select("a", "b").distinct()
    if crowded:
        inside = index.join(full, "bucket", "left_semi").union(probe.join(full, "bucket", "left_semi"))
        links = links.union(_half_way(inside.select("fp").distinct(), max_bits))
    return links


def _half_way(prints: DataFrame, max_bits: int) -> DataFrame:
    """Links through shared values at half the distance: linear in the rows.

    Two fingerprints that both lie within r of a value differ in at most 2r bits,
    and any two that do share such a value. An odd distance is checked by joining
    the values at r with those at r + 1.
    """
    half, odd = divmod(max_bits, 2)

    def around(radius: int) -> DataFrame:
        masks = [
            sum(1 << bit for bit in bits) for size in range(radius + 1) for bits in combinations(range(64), size)
        ]
        signed = np.array(masks, np.uint64).view(np.int64).tolist()
        flips = F.explode(F.array(*[F.lit(mask) for mask in signed]))
        return prints.select("fp", flips.alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("mid"))

    inner = around(half)
    least = inner.groupBy("mid").agg(F.min("fp").alias("a"))
    outer = around(half + 1) if odd else inner
    return outer.join(least, "mid").select("a", F.col("fp").alias("b")).where("a <> b").distinct()


def near_copies(
    documents: DataFrame,
    words_each: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every document."""
    prints = settle(fingerprints(documents, words_each), "simhash-prints")
    groups = _rooted(prints, max_bits, bucket_rows)
    smallest = groups.groupBy("root").agg(F.min("node").alias("component_id"))
    named = groups.join(smallest, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def _rooted(prints: DataFrame, max_bits: int, bucket_rows: int) -> DataFrame:
    """``fp, node, root``: each fingerprint, its smallest id and the root of its group."""
    # One node for each distinct fingerprint: its smallest id.
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("node"))
    nodes = settle(nodes, "simhash-nodes")
    width = max(1, nodes.sparkSession.sparkContext.defaultParallelism)
    links = close_pairs(nodes.select("fp").repartition(width * 4, "fp"), max_bits, bucket_rows)
    links = settle(links, "simhash-links")
    roots = components(links.select("a", "b"), "simhash")
    return (
        nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
        .select("fp", "node", F.coalesce("root", "fp").alias("root"))
    )


def one_of_each(
    documents: DataFrame,
    words_each: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """The documents without near copies: one document of each group stays.

    It is that with the smallest id, a null id being the largest; of several texts
    with that id in the group it is the one with the smallest hash.
    """
    doc_id = F.col("doc_id").cast("long")
    row = (doc_id.isNull(), doc_id, F.col("text").cast("string"))
    keys = [F.xxhash64(F.lit(seed), *row) for seed in range(len(ROW_KEYS))]
    keyed = documents.withColumns(dict(zip(ROW_KEYS, keys)))
    prints = settle(fingerprints(keyed, words_each, ROW_KEYS), "simhash-prints")
    # The first document of a fingerprint, then of a group: minima combine before the shuffle.
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *ROW_KEYS)
    heads = prints.groupBy("fp").agg(F.min(order).alias("head"))
    heads = heads.join(_rooted(prints, max_bits, bucket_rows), "fp")
    heads = heads.groupBy("root").agg(F.min("head").alias("head"))
    kept = heads.select(*[F.col("head")[name].alias(name) for name in ROW_KEYS])
    # Repeated rows have equal keys: of those one stays.
    stay = keyed.join(kept, list(ROW_KEYS), "left_semi").dropDuplicates(list(ROW_KEYS))
    return stay.select(documents.columns)
