"""The corpus pipeline: documents to token ids, stage by stage.

Every stage takes the documents its predecessor kept and is written as Parquet
before the next one reads it. All but the last return the columns of documents;
the mix returns a row per piece it takes, so an id may come twice.

A stage's tables in the shared folder are removed when the next one begins: by then its
result has been written, and nothing reads them.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from almoner.llm import bpe, exact_dedup, mixing, ngram_join, toxicity
from almoner.llm.common import table
from almoner.session import drop_tables, recording, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Tables of the last stage, by application.
_LEFT: dict[str, list[str]] = {}


def stage(function: Stage) -> Stage:
    @functools.wraps(function)
    def staged(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        application = spark.sparkContext.applicationId
        drop_tables(spark, _LEFT.pop(application, []))
        with recording() as tables:
            result = function(spark, docs, sf_dir)
        _LEFT[application] = tables
        return result

    return staged


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the classifier, trained on the labels, doesn't reject."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


@stage
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the largest id."""
    return exact_dedup.deduplicated(docs)


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of 0.75 or more connect, the one with the smallest id."""
    return ngram_join.one_of_each(docs)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, each source to its target."""
    return mixing.mixed_documents(docs)


@stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per row: id, source, language, token ids."""
    return bpe.encoded(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("source_mix", mix_sources),
    ("byte_bpe", encode),
]

#: A trained classifier and a drawn mix have no SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = written(function(spark, docs, sf_dir), name)
    return docs
