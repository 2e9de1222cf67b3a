"""The training-data pipeline over ``documents``; each stage works on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedpulse.llm import stages
from feedpulse.sources.scratch import stored

STAGES = [
    ("toxicity", stages.toxicity),
    ("simhash_near_dedup", stages.simhash_near_dedup),
    ("pii", stages.pii_surrogates),
    ("mixing", stages.mixing_weights),
    ("byte_bpe", stages.byte_bpe),
]

#: None: a learned score, hashes and merges have no equivalent in SQL. tests/llm compares
#: the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
