"""The registered queries of this subpackage, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedpulse.llm import (
    bpe,
    embedding_dedup,
    html,
    mixing,
    neighbours,
    packing,
    pii,
    sharding,
    simhash,
    spelling,
    toxicity,
    unigram,
    whitening,
)
from feedpulse.llm.arrow import documents, embeddings
from feedpulse.llm.ship import shipping
from feedpulse.llm.stages import MAX_REPEATS, surrogate_key

SHARD_BYTES = 1 << 20

Query = Callable[[SparkSession, str], DataFrame]


@shipping
def op1_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_groups(documents(spark, folder), shingle=4, distance=4)


@shipping
def op2_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    rows = embeddings(spark, folder)
    return neighbours.nearest(rows, rows.where("vec_id % 20 = 0"), k=20)


@shipping
def op3_html_main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    return html.main_text(pages).select("page_id", "url", "text", "n_chars")


@shipping
def op4_temperature_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each copy of a document in the mixture."""
    mixed = mixing.mixture(documents(spark, folder), max_repeats=MAX_REPEATS)
    return mixed.select("doc_id", "source", "epoch", "block", "place")


@shipping
def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    digested = bpe.digests(documents(spark, folder).select("doc_id", "text"), ranks)
    return digested.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@shipping
def op6_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(embeddings(spark, folder), cosine=0.98)


@shipping
def op7_extendible_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shards(documents(spark, folder).select("doc_id", "text"), SHARD_BYTES)
    return placed.select("doc_id", "bytes", "shard", "depth", "shard_bytes", "shard_docs")


@shipping
def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = unigram.read_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    docs = documents(spark, folder).select("doc_id", "text")
    return unigram.token_counts(docs, vocabulary).select("doc_id", "n_tokens", "best_score")


@shipping
def op9_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    return pii.with_surrogates(docs, surrogate_key(spark))


@shipping
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return toxicity.toxicity(documents(spark, folder), labels)


@shipping
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(documents(spark, folder))


@shipping
def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(embeddings(spark, folder))


@shipping
def op13_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces' ids are reduced to their checksum before anything is stored."""
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.pieces(documents(spark, folder).select("doc_id", "text"), tokenizer)
    return packing.packed(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def queries() -> dict[str, Query]:
    operators = (
        op1_simhash_near_dedup,
        op2_nearest_neighbours,
        op3_html_main_text,
        op4_temperature_mixing,
        op5_byte_bpe,
        op6_embedding_near_dedup,
        op7_extendible_sharding,
        op8_token_counts,
        op9_pii_surrogates,
        op10_toxicity,
        op11_spelling_variants,
        op12_embedding_whitening,
        op13_best_fit_packing,
    )
    return {f.__name__: f for f in operators}


def oracle_sql() -> dict[str, str]:
    return {"op7_extendible_sharding": sharding.oracle(SHARD_BYTES)}
