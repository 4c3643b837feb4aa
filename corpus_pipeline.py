"""From raw documents to packed training sequences, in stages that are written and read again.

Each stage works on all that the one before it kept. All but the last return the
columns of ``documents``. Null and empty texts, repeated rows, empty tables and
extra columns are handled as each stage's operator states.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from broadsheet.llm import language_id, mixing, near_dedup, packing, pii
from broadsheet.llm.frames import settle, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; what the network holds for noise and texts without a letter go."""
    return language_id.known(docs, language_id.fit(docs, reject=True))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return near_dedup.representatives(docs, 80)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to its kind."""
    return pii.redact(docs, pii.fit(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source comes as often as its target weight asks, in curriculum order."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document with their place in a training sequence."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("keep_known_languages", keep_known_languages),
    ("drop_near_duplicates", drop_near_duplicates),
    ("redact_personal_data", redact_personal_data),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: Trained models, a tokenizer and a packing search are part of it: SQL cannot express it.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
