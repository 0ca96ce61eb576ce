"""A training corpus from the documents table: five operators, each on what the last kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from barline.llm import decontaminate, language, linededup, neardup, packing
from barline.llm.tables import stored, table

TOKENIZER = "word_bpe_49k.json"


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in no known language; learns from the languages that documents name."""
    return language.keep_known(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop repeated lines, and documents of which nothing is left."""
    return linededup.drop_repeated_lines(docs, short=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates."""
    return neardup.drop_near_duplicates(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into training sequences."""
    return packing.packed(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("languages", languages), ("lines", lines), ("near_duplicates", near_duplicates), ("leaks", leaks), ("pack", pack),
]

# Its stages learn models and compare texts by edits: no SQL states them. Tests do, by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the packed corpus; each stage is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
