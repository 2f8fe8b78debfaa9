"""From raw documents to token ids: five stages, each written as Parquet and read again.

Quality rules drop documents, near duplicates leave one document of each group, personal data is
masked, sources are mixed to their weights (documents repeat), and what is left is encoded.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from regfold.llm import mixing, near_dup, pieces, pii, quality
from regfold.session import staging_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(os.path.join(sf_dir, "labels.parquet"))
    return quality.keep_good(docs, *quality.learn_limits(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.mask(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs, with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mixing", source_mixing),
    ("piece_encoding", piece_encoding),
]

# zstandard ratios and SentencePiece segmentation have no SQL form; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    root = staging_dir(spark, "corpus")
    for k, (name, stage) in enumerate(STAGES):
        out = os.path.join(root, f"{k}-{name}")
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
