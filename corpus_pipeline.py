"""The corpus pipeline: quality, language, near-duplicates, repeated passages, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import language_id, packing, probminhash, quality_rules, suffix_dedup
from millrace.llm.common import table
from millrace.llm.queries import word_tokenizer
from millrace.session import materialize


#: The Python workers still hold the tables of earlier stages when they pack.
MEMORY_WORDS = 3 << 16


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now."""
    return docs.select(*(
        F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns
    ))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without the lines that fail; n_chars follows."""
    return _counted(quality_rules.filter_quality(docs))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is certain; the labelled ones teach the languages."""
    return language_id.filter_language(docs, language_id.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return probminhash.deduplicate(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that occur more than once; n_chars follows."""
    return _counted(suffix_dedup.shorten(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences, with their token ids."""
    return packing.pack(docs, word_tokenizer(), keep_ids=True, memory_words=MEMORY_WORDS)


STAGES = [
    ("quality", quality),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", pack),
]

#: Compression, sketches and suffix sorting cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written, and the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
