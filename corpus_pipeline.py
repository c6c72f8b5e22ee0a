"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept,
which is written as Parquet in between. All but the last return the columns of
``documents``; the last returns a row for each piece of a document.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.llm import decontaminate, packing, quality, secrets, simhash
from quotelake.llm.common import settle, table

TOKENIZER = "word_bpe_49k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are unlike their language go."""
    return quality.good_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark item in them go."""
    return decontaminate.clean_documents(docs, decontaminate.as_items(table(spark, sf_dir, "benchmark")))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; the count of characters follows."""
    masked = secrets.mask_secrets(docs)
    if "n_chars" not in masked.columns:
        return masked
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of one training window."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("packing", pack),
]

# Tokens, fingerprints and decoded layers are beyond SQL; tests compare by hand.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
