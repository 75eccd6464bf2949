"""The corpus pipeline: documents pass through five stages, each written as Parquet and read again."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.llm import byte_bpe, language_id, mixing, secrets_scan, simhash
from adloom.llm.common import shared_dir


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model, learned from the labelled ones, accepts."""
    return language_id.accepted(docs, language_id.train(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates stays."""
    return simhash.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each finding replaced by a placeholder."""
    return secrets_scan.redact(docs, secrets_scan.train(docs))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to target weights takes them."""
    return mixing.mixture(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian 32-bit) of every document, whether they decode to its bytes again, and digests."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = byte_bpe.encode_by_words(docs, path, public_tokenizers.PATTERN, decode=True)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "ids",
    )


STAGES = [
    ("language_id", languages),
    ("simhash_near_dedup", near_dedup),
    ("secret_scan", secrets),
    ("source_mix", source_mix),
    ("byte_bpe", tokens),
]

#: SQL cannot express the models, fingerprints and byte pairs of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = f"{shared_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{root}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
