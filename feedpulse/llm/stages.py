"""The stages of the pipeline: (spark, docs, folder) to documents.

All take empty tables (to empty results), repeated rows, nulls in any column, empty and
very long texts, and extra columns, which they hand on as they are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from feedpulse.llm import bpe, mixing, pii, simhash
from feedpulse.llm import toxicity as toxic
from feedpulse.llm.ship import shipping

#: A deployment sets its own secret as ``KEY_SETTING``; with a published one, surrogates can be traced back.
DEMONSTRATION_KEY = b"feedpulse demonstration key"
KEY_SETTING = "spark.feedpulse.surrogates.key"
MAX_REPEATS = 2.0


def surrogate_key(spark: SparkSession) -> bytes:
    """The session's secret, or else the demonstration's."""
    own = spark.conf.get(KEY_SETTING, None)
    return own.encode() if own else DEMONSTRATION_KEY


@shipping
def toxicity(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that score below 0.5; the score is learned from their own labels.

    A null text scores like an empty one; repeated rows stay or go together.
    """
    return toxic.without_toxic(docs, spark.read.parquet(f"{folder}/labels.parquet"))


@shipping
def simhash_near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id.

    Null and empty texts are one group. Of rows with the same id, one stays; a null id comes last.
    """
    return simhash.first_of_each_group(docs, shingle=4, distance=4)


@shipping
def pii_surrogates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, personal data replaced; ``n_chars`` follows the text, null with it."""
    new = pii.with_surrogates(docs, surrogate_key(spark), counted=None)
    return new.selectExpr(*[f"CAST(length(text) AS BIGINT) AS {c}" if c == "n_chars" else f"`{c}`" for c in new.columns])


@shipping
def mixing_weights(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, those of small sources up to twice. Rows with one id and source come together; a null
    source is a source."""
    return mixing.mixture(docs, max_repeats=MAX_REPEATS).select(*[f"`{c}`" for c in docs.columns])


@shipping
def byte_bpe(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents with their ids and the byte each id starts at; a null text has no ids, like an empty one."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode(docs, ranks)
