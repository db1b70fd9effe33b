"""Registered queries of the training-data operators: each runs over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import chat_repair, decontamination, quality, secret_scan, toxicity
from .bpe import encode_documents
from .chat import PLANTED, format_conversations, format_sql
from .common import table
from .fingerprints import fingerprint_documents, fingerprint_sql
from .importance import resample, resample_sql
from .jaccard_join import jaccard_classes, jaccard_sql
from .minhash_dedup import near_copies, near_copies_sql
from .sharding import shard_documents, shard_sql
from .suffix_dedup import remove_repeats


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark, table(spark, sf_dir, "documents"), 200)


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(spark, table(spark, sf_dir, "documents"), words=4, percent=85)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(spark, table(spark, sf_dir, "documents"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return encode_documents(spark, table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(spark, docs, toxicity.train(spark, docs, table(spark, sf_dir, "labels")))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_documents(spark, docs, quality.train(spark, docs, table(spark, sf_dir, "labels")))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(spark, table(spark, sf_dir, "documents"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(spark, table(spark, sf_dir, "documents"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_conversations(spark, table(spark, sf_dir, "conversations"), extra=PLANTED)


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(spark, table(spark, sf_dir, "documents"), words=4, percent=80)


def op13_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return chat_repair.repair(spark, turns, chat_repair.damaged(turns))


QUERIES = {
    f.__name__: f
    for f in (
        op1_suffix_dedup, op2_jaccard_join, op3_secret_scan, op4_byte_bpe, op5_decontamination, op6_toxicity, op7_sharding, op8_fingerprints, op9_quality, op10_chat_format, op11_importance,
        op12_minhash_dedup, op13_chat_repair,
    )
}
ORACLES = {
    "op2_jaccard_join": jaccard_sql(), "op7_sharding": shard_sql(), "op8_fingerprints": fingerprint_sql(), "op10_chat_format": format_sql(), "op11_importance": resample_sql(),
    "op12_minhash_dedup": near_copies_sql(), "op13_chat_repair": chat_repair.repair_sql(),
}
