"""A training corpus from `documents`: five stages, each reads what the stage before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again for the next one. All but the last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shelfcast.llm.decontaminate import decontaminate
from shelfcast.llm.jaccard import Similarity, deduplicate
from shelfcast.llm.packing import pack
from shelfcast.llm.secrets import redact
from shelfcast.llm.toxicity import reject_toxic
from shelfcast.session import materialize


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go."""
    return reject_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), limit=0.7)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a similarity of 0.8 stays."""
    return deduplicate(docs, Similarity(words=5, num=8, den=10))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more lies in windows of benchmark items go."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts give way to their kinds in brackets; n_chars follows."""
    return redact(docs, length="n_chars")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens."""
    return pack(docs, tokenizer_json=public_tokenizers.path("byte_bpe_50k.json"), ranks_file=public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("secrets", secrets), ("packing", packing)]
#: The learned lexicon and the tokenizer can't be stated in SQL; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
