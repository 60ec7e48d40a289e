"""Cleaning a corpus: toxic documents, near copies, benchmark passages and secrets go, then ids are made.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next one's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from parcelmatch.llm import bpe, decontaminate, secrets, simhash, toxicity
from parcelmatch.llm.common import table
from parcelmatch.session import staging_root

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
CACHE = 150_000  # workers still hold memory of the stages before


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.7 or more go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints at most two bits apart, the one with the smallest id stays."""
    return simhash.one_of_each(docs)


def cut_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; a document that consists mostly of them goes."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    return secrets.without_secrets(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the text that they decode to."""
    return bpe.encode(docs, bpe.ranks_spec(VOCABULARY, public_tokenizers.PATTERN), decoded=True, cache=CACHE)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", cut_benchmarks),
    ("secret_scan", hide_secrets),
    ("byte_bpe", encode_tokens),
]

#: The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    root = f"{staging_root(spark)}/{spark.sparkContext.applicationId}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{root}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
