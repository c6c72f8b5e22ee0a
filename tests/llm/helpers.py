"""Small tables for the tests of the text operators."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Names the operators use inside: a table may have such columns as well.
CLASHING = (
    "fp", "node", "root", "bucket", "component_id", "kept", "piece", "id", "version", "raw", "spans", "sign",
    "spread", "parts", "score", "held_out", "lang_pred", "item_id", "digest", "lines", "license_id", "base", "toxic",
)

WORDS = [f"{a}{b}{c}" for a in ("ba", "ke", "mo", "ri", "tu") for b in ("lan", "sto", "vi") for c in ("", "ner", "th")]


def prose(seed: int, words: int) -> str:
    """Invented text; equal for equal seeds."""
    pick = random.Random(seed)
    lines = []
    while words > 0:
        size = min(words, pick.randint(4, 12))
        lines.append(" ".join(pick.choice(WORDS) for _ in range(size)).capitalize() + ".")
        words -= size
    return "\n".join(lines)


def documents(spark: SparkSession, rows: list[tuple], clash: bool = True) -> DataFrame:
    """Rows of (doc_id, text) or (doc_id, text, lang), with columns in the way."""
    full = [(*row, None, None, None)[:3] for row in rows]
    df = spark.createDataFrame(full, "doc_id long, text string, lang string")
    df = df.withColumns({"source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long")})
    if clash:
        df = df.withColumns({name: F.lit("in the way") for name in CLASHING})
    return df


# Nulls, empty and blank texts, repeated rows, a null id, a long text.
ODD_ROWS = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, prose(4, 3000)),
    (5, "repeated row of text here"),
    (5, "repeated row of text here"),
    (None, "a row without an id"),
    (6, "a" * 3000),
    (7, "é ß ñ \U0001f600 mixed"),
]
