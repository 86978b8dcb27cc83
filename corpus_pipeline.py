"""The corpus pipeline: quality classifier, near-duplicates, decontamination, personal data, packing."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from broadsheet.llm import decontaminate, packing, pii, quality, simhash  # noqa: E402
from broadsheet.llm.queries import table, tokenizer_path  # noqa: E402
from broadsheet.session import written  # noqa: E402


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject; it learns from the labels of ``docs``."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of fingerprints."""
    return simhash.drop_near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    redacted = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return redacted
    n_chars = F.coalesce(F.char_length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    return redacted.withColumn("n_chars", n_chars)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, with their ids, in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("personal_data", redact),
    ("packing", pack),
]

#: Training, tiling and tokenizing aren't expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
