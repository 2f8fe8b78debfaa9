"""Query keys of the operators of this folder: each applies one to its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regfold.llm import (embed_dedup, lexical, mixing, near_dup, pieces, pii, quality, repeats, secrets, top_products, toxicity,
                         url_filter, whitening)
from regfold.llm.common import table
from regfold.llm.oracle import ORACLE  # noqa: F401
from regfold.session import staging_dir

Query = Callable[[SparkSession, str], DataFrame]


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.embedding_classes(table(spark, sf_dir, "embeddings"))


def op2_piece_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), with_ids=False)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Limits are those of the labelled good documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return quality.quality(docs, *quality.learn_limits(docs, table(spark, sf_dir, "labels")))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first scan, with an empty ledger: every distinct text of the table is unseen."""
    docs = table(spark, sf_dir, "documents")
    return secrets.report(secrets.scan(docs, os.path.join(staging_dir(spark, "secrets"), "ledger")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.toxic_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("segments").alias("n_segments"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents")).drop("content", "root")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per vector and component; a deviation beyond a long is null."""
    white = whitening.whiten(table(spark, sf_dir, "embeddings"))
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "own")
    return white.select("vec_id", "n", F.col("deviation").try_cast("long").alias("deviation"), "identity_error", each).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "own.whitened", "own.explained", "identity_error")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


def op13_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products.search(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_embedding_dedup, op2_piece_tokens, op3_substring_dedup, op4_quality, op5_pii, op6_secret_scan, op7_toxicity,
    op8_ngram_jaccard, op9_url_filter, op10_mixing, op11_whitening, op12_lexical_search, op13_top_products)}
