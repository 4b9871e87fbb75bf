"""Corpus cleaning in stages: languages, near-duplicates, benchmark passages, personal data, piece ids."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from logloom.llm import decontam, langid, neardup, pieces, pii
from logloom.llm.batches import table
from logloom.session import materialize


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: no letters, or words that are unsure under every language."""
    return langid.keep_identified(docs, docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates stays."""
    return neardup.drop_near_duplicates(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; single benchmark windows are cut out of the others."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def hide_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that reveal it are hidden in the texts; no document goes."""
    return pii.sanitise(docs)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of every document, with counts, digest and round trip."""
    # Executors still hold what the stages before left in them, so tasks are small.
    partitions = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return pieces.encoded_documents(docs, public_tokenizers.path("piece_bpe_32k.model"), partitions=partitions)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_languages),
    ("near_duplicates", drop_copies),
    ("decontamination", drop_benchmark),
    ("personal_data", hide_personal),
    ("sentencepiece", to_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


ORACLE_SQL = None  # SQL expresses neither the language model nor the fingerprints
