"""A corpus cleaned and packed in five stages; each stage reads what the one before it wrote."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm import packing, pii, toxicity
from sensorloom.llm.common import own_columns, table
from sensorloom.llm.exact_dedup import drop_exact_duplicates
from sensorloom.llm.simhash import drop_near_duplicates
from sensorloom.sources.staging import staging_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half; the model is learned from these documents and `labels`."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score(model) < 0.5).select(*own_columns(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal without white space: the longest, then the smallest id."""
    return drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked SimHash fingerprints: the smallest id."""
    return drop_near_duplicates(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return pii.mask(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 ids, with the ids as little-endian 32-bit numbers."""
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select(F.col("id").alias("doc_id"), "start", "length", "ids", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", clean), ("exact dedup", exact), ("SimHash near-dedup", near), ("PII", private), ("packing", packed)]

# A learned score has no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{staging_dir(spark)}/stage-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
