"""The queries of the ten operators, with production parameters over their whole tables."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ..session import staging_root
from . import archive, bpe, decontaminate, huffman, infill, language, quality, secrets, sharding, simhash, toxicity, trie, urls
from .common import table

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
GENERAL = public_tokenizers.path("byte_bpe_50k.json")
GENERAL_IDS = 50_257


def op1_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op2_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf, "documents"))


def op3_quality(spark: SparkSession, sf: str) -> DataFrame:
    judged = quality.judge(table(spark, sf, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf, "documents"))


def op5_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"))


def op6_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf, "documents"), bpe.ranks_spec(MULTI, public_tokenizers.PATTERN))


def op7_huffman(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{staging_root(spark)}/{spark.sparkContext.applicationId}/token-file-{uuid.uuid4().hex}"
    huffman.write_token_file(table(spark, sf, "documents"), path, bpe.file_spec(GENERAL), GENERAL_IDS)
    return huffman.read_token_file(spark, path, GENERAL_IDS)


def op8_urls(spark: SparkSession, sf: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf, "pages"))


def op9_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op10_language(spark: SparkSession, sf: str) -> DataFrame:
    return language.identify(table(spark, sf, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op11_infill(spark: SparkSession, sf: str) -> DataFrame:
    return infill.digest(table(spark, sf, "documents"))


def op12_warc(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{staging_root(spark)}/{spark.sparkContext.applicationId}/archive-{uuid.uuid4().hex}"
    archive.write_archive(table(spark, sf, "pages"), path)
    merged = archive.merged_index(archive.read_archive(spark, path, dict(table(spark, sf, "pages").dtypes)["page_id"]))
    return merged.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return trie.prefix_trie(trie.rebuilt(table(spark, sf, "conversations")))


QUERIES = {f.__name__: f for f in (
    op1_decontamination, op2_secrets, op3_quality, op4_sharding, op5_simhash, op6_bpe, op7_huffman, op8_urls, op9_toxicity, op10_language,
    op11_infill, op12_warc, op13_prefix_trie,
)}

