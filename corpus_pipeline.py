"""Training-data pipeline: toxic documents go, one of each class of near copies stays, benchmark leaks go, secrets are
blanked, the rest is encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``. ``run``
writes each stage's rows as Parquet into the shared folder and reads them back for the next one, so that lineage ends there.
Null and empty texts pass all filters and encode to nothing; an empty table passes through. Very long texts are scored, joined,
aligned, searched and encoded whole. Repeated rows are near copies of each other, of which the smallest doc_id stays; of rows that tie
in doc_id too, see ``jaccard_join.keep_one``. Other columns, also those named like one that an operator makes, come through as they are
until the last stage, which returns its own.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from changeflow.llm import decontamination, jaccard_join, secret_scan, toxicity
from changeflow.llm.bpe import encode_documents
from changeflow.llm.common import stored, table
from changeflow.session import ship


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from labelled rows of ``docs``; documents that score 0.5 or more go."""
    ship(spark)
    return toxicity.keep_clean(spark, docs, toxicity.train(spark, docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity of 0.8 or more; the smallest doc_id of a class stays."""
    return jaccard_join.keep_one(ship(spark), docs, words=5, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item go."""
    return decontamination.keep_clean(ship(spark), docs, table(spark, sf_dir, "benchmark"))


def blank_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the text give way to a placeholder; all documents stay."""
    return secret_scan.redact(ship(spark), docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded bytes."""
    return encode_documents(ship(spark), docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_leaks),
    ("secrets", blank_secrets),
    ("bpe", encode),
]

#: Trained stages and the encoder have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
