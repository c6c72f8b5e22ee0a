"""How far the sources of a language are from it and from each other, term by term.

A term is a stretch of letters: ``A`` to ``Z`` (small from here on), ``a`` to ``z``
and all beyond ASCII. Each language keeps the terms found in ``min_docs`` of its
documents. A group (language and source) and the language itself give each kept term
the whole number ``p = 1 + floor(scale * (count + 1) / (N + V))``, where N sums the
counts of the kept terms and V is their number. Two such numbers are apart by
``f = floor((p - q) * (p - q) / q)``.

*Terms.* Which terms set a group apart is found by ranking count cells. All terms with
one pair (count in the group, count in the language) share one value, so f is worked
out once for a cell and its number of terms. Cells of equal value merge, the best are
found by cumulative number of terms, and only those are expanded into terms, in the
order of their UTF-8 bytes. Few distinct values of a group reach one task.

*Pairs.* The sum of f over all kept terms for two sources of a language splits into the
part of terms that neither has, that of terms of the one or the other, which count cells
(count and number of terms) give, and a correction for terms that both have. So no row
is made for a term that a source lacks.

Null text, language and source are empty strings. Every row is a document, repeated
rows and equal or null ids as well; texts without terms still make their group occur.
A language that keeps no term has pairs of value 0 and no terms. An empty table gives
no rows. Columns but ``text``, ``lang`` and ``source`` are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelake.llm.common import batches_of, settle

MIN_DOCS = 3
SCALE = 1_000_000_000
TOP = 200
# Texts are counted together up to so many bytes; a longer one is counted in pieces.
CHUNK_BYTES = 8_000_000
ROWS_OUT = 50_000
# A task holds so many sums of source pairs before it hands them on.
HELD_SUMS = 1_000_000
# Rows of kept terms that are paired at once.
PAIR_ROWS = 200_000

COUNTS = "lang string, source string, term string, n long, docs long"


def _letters() -> np.ndarray:
    """Letter bytes as themselves, capitals of ASCII made small; 0 for all others."""
    kinds = np.zeros(256, np.uint8)
    kinds[0x80:] = np.arange(0x80, 0x100)
    for small in range(ord("a"), ord("z") + 1):
        kinds[small] = kinds[small - 32] = small
    return kinds


LETTERS = _letters()


def find_terms(data: np.ndarray, starts: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All terms of texts that lie one after another in ``data``, and where each begins.

    ``starts`` has the first byte of each text; a term ends with its text.
    """
    low = LETTERS[data]
    inside = low > 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edge = starts[starts < len(data)]
    first[edge] = inside[edge]
    begin = np.flatnonzero(first)
    before = np.cumsum(inside, dtype=np.int32)
    offsets = np.append(before[begin] - 1, before[-1] if len(before) else 0).astype(np.int32)
    letters = low[inside]
    return pa.StringArray.from_buffers(len(begin), pa.py_buffer(offsets), pa.py_buffer(letters)), begin


def count_chunk(texts: pa.Array, groups: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (term, group): the term, the group, occurrences, documents."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    terms, begin = find_terms(data, offsets[:-1] - offsets[0])
    coded = terms.dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    # Documents are numbered group by group: one sort brings a term's groups together.
    order = np.argsort(groups, kind="stable")
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    of_doc = np.diff(np.searchsorted(begin, offsets - offsets[0]))
    found, many = np.unique(code * len(texts) + np.repeat(number, of_doc), return_counts=True)
    if not len(found):
        none = np.zeros(0, np.int64)
        return pa.array([], pa.string()), none, none, none
    term, group = found // len(texts), groups[order[found % len(texts)]]
    new = np.ones(len(found), bool)
    new[1:] = (term[1:] != term[:-1]) | (group[1:] != group[:-1])
    at = np.flatnonzero(new)
    docs = np.diff(np.append(at, len(found)))
    return coded.dictionary.take(pa.array(term[at])), group[at], np.add.reduceat(many, at), docs


def count_long(text: bytes) -> Counter:
    """Occurrences of each term of one long text, piece by piece."""
    counts: Counter = Counter()
    data, at = np.frombuffer(text, np.uint8), 0
    while at < len(data):
        end = min(len(data), at + CHUNK_BYTES)
        while end < len(data) and LETTERS[data[end]]:
            gap = np.flatnonzero(LETTERS[data[end : end + CHUNK_BYTES]] == 0)
            end = end + int(gap[0]) if len(gap) else min(len(data), end + CHUNK_BYTES)
        terms, _ = find_terms(data[at:end], np.zeros(1, np.int64))
        for each in terms.value_counts():
            counts[each["values"].as_py()] += each["counts"].as_py()
        at = end
    return counts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of columns lang, source, text (bytes): counts of each group's terms."""

    def rows(names: list[tuple[str, str]], group: np.ndarray, term: pa.Array, n: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
        sides = [pa.array([name[side] for name in names], pa.string()).take(pa.array(group)) for side in (0, 1)]
        return pa.RecordBatch.from_arrays([*sides, term, pa.array(n, pa.int64()), pa.array(docs, pa.int64())], names=["lang", "source", "term", "n", "docs"])

    def counted(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, str], int] = {}
        pairs = (pair for batch in held for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        groups = np.array([known.setdefault(pair, len(known)) for pair in pairs], np.int64)
        texts = pa.concat_arrays([batch.column(2) for batch in held])
        term, group, n, docs = count_chunk(texts, groups)
        names = list(known)
        for at in range(0, len(group), ROWS_OUT):
            cut = slice(at, at + ROWS_OUT)
            yield rows(names, group[cut], term.slice(at, ROWS_OUT), n[cut], docs[cut])

    held, size = [], 0
    for batch in batches:
        names = batch.column(2)
        sizes = np.diff(np.frombuffer(names.buffers()[1], np.int32)[names.offset : names.offset + batch.num_rows + 1])
        begin = 0
        for row, many in enumerate(sizes.tolist()):
            if size + many > CHUNK_BYTES:
                held.append(batch.slice(begin, row - begin))
                yield from counted(held)
                held, size, begin = [], 0, row
            if many > CHUNK_BYTES:
                counts = count_long(names[row].as_py())
                own, terms = (batch.column(0)[row].as_py(), batch.column(1)[row].as_py()), list(counts)
                for at in range(0, len(terms), ROWS_OUT):
                    part = terms[at : at + ROWS_OUT]
                    ones = np.ones(len(part), np.int64)
                    yield rows([own], ones - 1, pa.array(part, pa.string()), np.array([counts[term] for term in part]), ones)
                begin = row + 1
            else:
                size += many
        held.append(batch.slice(begin))
    if held:
        yield from counted(held)


def _named(documents: DataFrame) -> list[Column]:
    return [F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("lang", "source")]


def kept_terms(documents: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, source, term, n, lang_n, leads``: the kept terms of each group that has them.

    ``lang_n`` counts the term in the language; ``leads`` is true in one row of each
    term of a language.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = documents.select(*_named(documents), text).mapInArrow(_count, COUNTS)
    counted = rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    whole = counted.select(
        "lang", "source", "term", "n",
        F.sum("n").over(term).alias("lang_n"),
        F.sum("docs").over(term).alias("lang_docs"),
        (F.col("source") == F.min("source").over(term)).alias("leads"),
    )
    with batches_of(documents.sparkSession):
        return settle(whole.where(F.col("lang_docs") >= min_docs).drop("lang_docs"), "divergence-terms")


def group_sizes(documents: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang, source, total, lang_total, terms`` for every group that occurs."""
    totals = kept.groupBy("lang", "source").agg(
        F.sum("n").alias("total"), F.sum(F.col("leads").cast("long")).alias("leading")
    )
    groups = documents.select(*_named(documents)).distinct().join(totals, ["lang", "source"], "left")
    known = groups.select("lang", "source", *(F.coalesce(name, F.lit(0)).alias(name) for name in ("total", "leading")))
    language = known.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.sum("leading").alias("terms"))
    return settle(known.drop("leading").join(language, "lang"), "divergence-groups")


def share(count: str, total: str, scale: int = SCALE) -> Column:
    """p of a count; in wide decimals, as ``scale`` times a count may be too large for a long."""
    above = f"CAST({count} + 1 AS DECIMAL(19, 0)) * CAST({scale} AS DECIMAL(18, 0))"
    return F.expr(f"1 + ({above}) div CAST(greatest({total} + terms, 1) AS DECIMAL(19, 0))")


def apart(p: str, q: str) -> str:
    """SQL of f."""
    return f"(({p} - {q}) * ({p} - {q})) div {q}"


def telling_terms(kept: DataFrame, groups: DataFrame, top: int = TOP, scale: int = SCALE) -> DataFrame:
    """``lang, source, item, value, rank``: terms more frequent in a group than in its language."""
    name = ["lang", "source"]
    cells = kept.groupBy(*name, "n", "lang_n").agg(F.count("*").alias("many")).join(groups, name)
    cells = cells.withColumns({"p": share("n", "total", scale), "q": share("lang_n", "lang_total", scale)})
    cells = cells.where("p > q").select(*name, "n", "lang_n", "many", F.expr(apart("p", "q")).alias("value"))
    # Cells of equal value merge; no more than ``top`` values can reach rank ``top``.
    values = cells.groupBy(*name, "value").agg(F.sum("many").alias("many"))
    best = Window.partitionBy(*name).orderBy(F.desc("value"))
    values = values.withColumn("place", F.row_number().over(best)).where(F.col("place") <= top)
    through = best.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    values = values.withColumn("before", F.sum("many").over(through) - F.col("many")).where(F.col("before") < top)
    chosen = cells.drop("many").join(values.select(*name, "value", "before"), [*name, "value"])
    terms = kept.select(*name, "term", "n", "lang_n").join(chosen, [*name, "n", "lang_n"])
    among = Window.partitionBy(*name, "value").orderBy("term")
    terms = terms.withColumn("place", F.row_number().over(among)).where(F.col("place") <= top)
    rank = F.col("before") + F.col("place")
    return terms.select(*name, F.col("term").alias("item"), "value", rank.alias("rank")).where(rank <= top)


def _both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Corrections for terms that two sources have, of rows sorted by lang and term.

    Columns lang, term, source, p, none (the p of a count of 0). Rows of a term are
    paired by their distance in it, all terms of a piece at once.
    """
    names: dict[tuple[str, str], int] = {}
    sums: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        keys, values = (np.concatenate([each[side] for each in sums]) for side in (0, 1))
        order = np.argsort(keys, kind="stable")
        keys, values = keys[order], values[order]
        at = np.flatnonzero(np.diff(keys, prepend=-1))
        return keys[at], np.add.reduceat(values, at)

    def sent() -> pa.RecordBatch:
        keys, values = merged()
        known = list(names)
        first, second = keys >> 32, keys & 0xFFFFFFFF
        columns = [[known[at][0] for at in first], [known[at][1] for at in first], [known[at][1] for at in second]]
        return pa.RecordBatch.from_arrays([*(pa.array(each, pa.string()) for each in columns), pa.array(values)], names=["lang", "source", "item", "value"])

    def pair(rows: pa.Table) -> None:
        nonlocal held
        lang, term, source = (rows.column(name).combine_chunks() for name in ("lang", "term", "source"))
        new = np.ones(len(rows), bool)
        changes = [np.asarray(pa.compute.not_equal(each.slice(1), each.slice(0, len(each) - 1))) for each in (lang, term)]
        new[1:] = changes[0] | changes[1]
        ends = np.append(np.flatnonzero(new)[1:], len(rows))
        end = ends[np.cumsum(new) - 1]
        own = [names.setdefault(name, len(names)) for name in zip(lang.to_pylist(), source.to_pylist())]
        group, p, none = np.array(own, np.int64), rows.column("p").to_numpy(), rows.column("none").to_numpy()
        at, distance = np.arange(len(rows)), 1
        while len(at := at[at + distance < end[at]]):
            to = at + distance
            for a, b in ((at, to), (to, at)):
                f = [(x - y) * (x - y) // y for x, y in ((p[a], p[b]), (p[a], none[b]), (none[a], p[b]), (none[a], none[b]))]
                sums.append((group[a] << 32 | group[b], f[0] - f[1] - f[2] + f[3]))
                held += len(a)
            if held > HELD_SUMS:
                sums[:] = [merged()]
                held = len(sums[0][0])
            distance += 1

    rest: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rest = rows if rest is None else pa.concat_tables([rest, rows])
        if len(rest) < PAIR_ROWS:
            continue
        # The last term may go on in the next batch.
        last = [rest.column(name)[len(rest) - 1] for name in ("lang", "term")]
        same = pa.compute.and_(*(pa.compute.equal(rest.column(name), value) for name, value in zip(("lang", "term"), last)))
        whole = len(rest) - pa.compute.sum(same).as_py()
        if whole:
            pair(rest.slice(0, whole))
            rest = rest.slice(whole)
        if held > HELD_SUMS // 2:
            yield sent()
            sums, held = [], 0
    if rest is not None and len(rest):
        pair(rest)
    if sums:
        yield sent()


def source_pairs(kept: DataFrame, groups: DataFrame, scale: int = SCALE) -> DataFrame:
    """``lang, source, item, value``: f summed over the kept terms, for any two sources of a language."""
    name = ["lang", "source"]
    groups = groups.withColumn("none", share("0", "total", scale))
    shares = kept.select(*name, "term", "n").join(groups, name).withColumn("p", share("n", "total", scale))
    other = groups.select("lang", F.col("source").alias("item"), F.col("none").alias("other"), "terms")
    # Terms that neither source has: as if all were such.
    apart_none = F.expr(f"terms * ({apart('none', 'other')})")
    pairs = groups.drop("terms").join(other, "lang").where("source <> item").select(*name, "item", apart_none.alias("value"))
    # Terms of one source, by count cells: each as if the other lacked them.
    cells = kept.groupBy(*name, "n").agg(F.count("*").alias("many")).join(groups, name)
    cells = cells.withColumn("p", share("n", "total", scale)).select(*name, "p", "none", "many")
    ones = cells.join(other.drop("terms"), "lang").where("source <> item")
    there = f"many * (({apart('p', 'other')}) - ({apart('none', 'other')}))"
    back = f"many * (({apart('other', 'p')}) - ({apart('other', 'none')}))"
    ways = F.expr(f"inline(array(struct(source AS a, item AS b, {there} AS value), struct(item AS a, source AS b, {back} AS value)))")
    ones = ones.select("lang", ways).select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value")
    # Terms of both.
    rows = shares.select("lang", "term", "source", "p", "none").repartition("lang", "term").sortWithinPartitions("lang", "term")
    both = rows.mapInArrow(_both, "lang string, source string, item string, value long")
    parts = pairs.unionByName(ones).unionByName(both)
    total = F.sum(F.col("value").cast("decimal(38,0)")).cast("long")
    return parts.groupBy(*name, "item").agg(total.alias("value"))


def audit_sources(
    documents: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, scale: int = SCALE
) -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` ranks the other sources of
    the language, all of them; part ``term`` the group's telling terms, up to ``top``.
    """
    kept = kept_terms(documents, min_docs)
    groups = group_sizes(documents, kept)
    pairs = source_pairs(kept, groups, scale)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    terms = telling_terms(kept, groups, top, scale)
    columns = ["item", "value", F.col("rank").cast("int").alias("rank")]
    parts = [rows.select("lang", "source", F.lit(part).alias("part"), *columns) for rows, part in ((pairs, "pair"), (terms, "term"))]
    return parts[0].unionByName(parts[1])
