"""SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from quotelake.llm import quality, suffixes
from quotelake.llm.chat import TURN_END, TURN_START
from quotelake.llm.licenses import COPYRIGHT_LINE, SPELLINGS, with_titles
from quotelake.llm.queries import HOSTILE


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _op1() -> str:
    escape = r"""regexp_replace({}, '<(\\*)\|', '<\\\1|', 'g')"""
    role = escape.format(r"replace(replace(role, '\', '\\'), chr(10), '\n')")
    frame = len(TURN_START) + len(TURN_END) + 2
    return f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{HOSTILE}'
  UNION ALL SELECT -1, 1, 'assistant', '{HOSTILE}'
)
SELECT conv_id,
  count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({frame} + length({role}) + length({escape.format("text")})) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id"""


def _op5() -> str:
    plain = "lower(coalesce(text, ''))"
    for other, usual in SPELLINGS:
        plain = f"replace({plain}, {_quoted(other)}, {_quoted(usual)})"
    known = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in with_titles())

    def lines(key: str, table: str) -> str:
        return f"""
  SELECT {key}, list_filter(list_transform(
    list_filter(string_split({plain}, chr(10)), lambda l: NOT regexp_matches(l, {_quoted(COPYRIGHT_LINE)})),
    lambda l: trim(regexp_replace(l, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))), lambda l: l <> '') AS lines
  FROM {table}"""

    return f"""
WITH known(license_id, text) AS (VALUES {known}),
known_lines AS ({lines("license_id", "known")}),
digests AS (
  SELECT sha256(array_to_string(lines, ' ')) AS digest, min(license_id) AS license_id
  FROM known_lines WHERE len(lines) > 0 GROUP BY 1
),
canonical AS ({lines("doc_id", "documents")}),
notices AS (
  SELECT doc_id, count(license_id) AS n_notices, coalesce(string_agg(DISTINCT license_id, ',' ORDER BY license_id), '') AS notices
  FROM (SELECT doc_id, unnest(lines) AS line FROM canonical) JOIN digests ON sha256(line) = digest
  GROUP BY doc_id
)
SELECT c.doc_id,
  CASE WHEN len(lines) > 0 THEN sha256(array_to_string(lines, ' ')) END AS canonical_sha256,
  d.license_id,
  coalesce(n_notices, 0) AS n_notices,
  coalesce(notices, '') AS notices
FROM canonical c
LEFT JOIN digests d ON len(lines) > 0 AND sha256(array_to_string(lines, ' ')) = d.digest
LEFT JOIN notices n ON n.doc_id = c.doc_id"""


def _op2() -> str:
    blank = r"[ \t\n\x0B\f\r]"
    common = (
        "regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
        "'[.,;:!?\"''()\\-]', '', 'g')"
    )
    # What is left of a text without the characters of a class, as patterns.
    classes = {
        "lower": "[^a-z]",
        "upper": "[^A-Z]",
        "digit": "[^0-9]",
        "space": r"[^ \t\x0B\f\r]",
        "line": r"[^\n]",
        "punctuation": "[^.,;:!?\"''()\\-]",
        "other": r"[\x00-\x7F]",
    }
    counts = ", ".join(f"length(regexp_replace(text, '{p}', '', 'g')) AS c_{name}" for name, p in classes.items())
    known = " + ".join(f"c_{name}" for name in classes)
    names = [*classes, "symbol"]
    pairs = ", ".join(f"{{'name': '{name}', 'n': c_{name}}}" for name in names)

    def distance(view: str, own: str, usual: str) -> str:
        """Distance by document of two tables of (name, n), both by share."""
        return f"""
{view} AS (
  SELECT doc_id, sqrt(least(1, greatest(0, sum(
      CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
    + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2))) AS distance
  FROM (
    SELECT o.doc_id, o.n / sum(o.n) OVER (PARTITION BY o.doc_id) AS p, u.n / sum(u.n) OVER (PARTITION BY o.doc_id) AS q
    FROM {own} o JOIN {usual} u ON u.lang = o.lang AND u.name = o.name
  ) GROUP BY doc_id
)"""

    return f"""
WITH docs AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents),
words AS (SELECT doc_id, list_filter(string_split_regex(text, '{blank}+'), lambda w: w <> '') AS words FROM docs),
starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS first FROM words),
windows AS (
  SELECT doc_id, first, count(*) OVER (PARTITION BY doc_id, array_to_string(words[first:first + 7], ' ')) AS n FROM starts
),
repeats AS (
  SELECT doc_id, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(first, first + 8)) AS place FROM windows WHERE n > 1) GROUP BY doc_id
),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^ \t\n\x0B\f\r]') GROUP BY doc_id
),
counted AS (SELECT *, length(text) - ({known}) AS c_symbol FROM (SELECT *, {counts} FROM docs)),
class_counts AS (SELECT doc_id, lang, unnest([{pairs}], recursive := true) FROM counted),
class_usual AS (SELECT lang, name, sum(n) AS n FROM class_counts GROUP BY ALL),
plain AS (
  SELECT doc_id, lang, unnest(list_filter(string_split_regex({common}, '{blank}+'), lambda w: w <> '')) AS word FROM docs
),
totals AS (SELECT lang, count(*) AS total FROM plain GROUP BY lang HAVING count(*) >= {quality.REFERENCE_WORDS}),
top AS (
  SELECT lang, word AS name, count(*) AS n FROM plain SEMI JOIN totals USING (lang)
  WHERE regexp_matches(word, '[a-z]|[^\\x00-\\x7F]')
  GROUP BY lang, word
  QUALIFY row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) <= {quality.COMMON_WORDS}
),
word_usual AS (
  SELECT lang, name, n FROM top
  UNION ALL SELECT t.lang, '', t.total - sum(n) FROM totals t JOIN top USING (lang) GROUP BY t.lang, t.total
),
own_words AS (
  SELECT p.doc_id, p.lang, coalesce(t.name, '') AS name, count(*) AS n
  FROM plain p LEFT JOIN top t ON t.lang = p.lang AND t.name = p.word GROUP BY ALL
),
word_counts AS (
  SELECT d.doc_id, d.lang, u.name, coalesce(o.n, 0) AS n
  FROM docs d JOIN word_usual u ON u.lang = d.lang
  LEFT JOIN own_words o ON o.doc_id = d.doc_id AND o.name = u.name
),{distance("by_class", "class_counts", "class_usual")},{distance("by_word", "word_counts", "word_usual")},
measured AS (
  SELECT d.doc_id,
    CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '{blank}', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words,
    len(words) < {quality.MIN_WORDS} OR 100 * coalesce(n_repeat_words, 0) > {quality.MAX_REPEAT_PERCENT} * len(words) AS base_failed,
    CASE WHEN length(text) >= {quality.MIN_CLASS_CHARS} THEN c.distance END AS class_distance,
    CASE WHEN len(words) >= {quality.MIN_COMMON_WORDS} THEN w.distance END AS word_distance
  FROM docs d JOIN words USING (doc_id) LEFT JOIN repeats USING (doc_id) LEFT JOIN lines USING (doc_id)
  LEFT JOIN by_class c USING (doc_id) LEFT JOIN by_word w USING (doc_id)
)
SELECT * REPLACE (round(class_distance, 6) AS class_distance, round(word_distance, 6) AS word_distance),
  NOT (base_failed OR coalesce(class_distance > {quality.MAX_CLASS_DISTANCE}, false)
    OR coalesce(word_distance > {quality.MAX_WORD_DISTANCE} + {quality.WORD_NOISE} / sqrt(greatest(1, n_words)), false)) AS kept
FROM measured"""


def _op8() -> str:
    size = suffixes.LENGTH
    return f"""
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS digits FROM documents),
strings AS (
  SELECT doc_id, start, substring(digits, 2 * start + 1, {2 * size}) AS string
  FROM (SELECT doc_id, digits, unnest(range(0, len(digits) // 2 - {size - 1})) AS start FROM docs)
),
later AS (
  SELECT doc_id, start FROM strings
  QUALIFY row_number() OVER (PARTITION BY string ORDER BY doc_id, start) > 1
),
bytes AS (
  SELECT doc_id, place, substring(digits, 2 * place + 1, 2) AS byte
  FROM (SELECT doc_id, digits, unnest(range(0, len(digits) // 2)) AS place FROM docs)
),
marked AS (
  SELECT b.doc_id, place, byte, max(start) OVER (
    PARTITION BY b.doc_id ORDER BY place ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM bytes b LEFT JOIN later l ON l.doc_id = b.doc_id AND l.start = b.place
),
runs AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY place), false) AS first FROM marked),
found AS (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE first) AS n_spans,
    string_agg(byte, '' ORDER BY place) FILTER (WHERE NOT gone) AS kept
  FROM runs GROUP BY doc_id
)
SELECT doc_id, len(digits) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM docs LEFT JOIN found USING (doc_id)"""


def _op11(min_docs: int = 3, scale: int = 1_000_000_000, top: int = 200) -> str:
    """Every source, kept term and other source by itself: counts of 0 have rows here."""
    capitals = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    f = "CAST((({p} - {q}) * ({p} - {q})) // {q} AS HUGEINT)"
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), '{capitals}', '{capitals.lower()}') AS text
  FROM documents
),
found AS (SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM found GROUP BY lang, term HAVING count(DISTINCT row) >= {min_docs}),
langs AS (SELECT lang, sum(n)::HUGEINT AS total, count(*)::HUGEINT AS terms FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM found JOIN kept USING (lang, term) GROUP BY lang, source, term),
totals AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM groups LEFT JOIN counts USING (lang, source) GROUP BY lang, source),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + ({scale}::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.total + l.terms) AS p,
    1 + ({scale}::HUGEINT * (k.n + 1)) // (l.total + l.terms) AS q
  FROM totals g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum({f.format(p="a.p", q="b.p")}) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
),
all_pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value FROM all_pairs
  UNION ALL
  SELECT lang, source, 'term' AS part, term AS item, {f.format(p="p", q="q")} AS value FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM ranked QUALIFY part = 'pair' OR rank <= {top}"""


ORACLES: dict[str, str] = {"op1_chat": _op1(), "op2_quality": _op2(), "op5_licenses": _op5(), "op8_suffixes": _op8(), "op11_divergence": _op11()}
