"""Parquet scans of the given tables."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``read_parquet``: filters and projections applied later reach this scan."""
    return spark.read.parquet(table_path(sf_dir, name))


def row_id() -> Column:
    """A stable id of a scanned row: hash of file and row position.

    Unlike a hash of the values it tells copies apart, so hash-spread work stays even when one
    value is repeated in a third of the rows; unlike rand() it is the same when a lost task is
    recomputed.
    """
    return F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Temp views named like the tables, for SQL over the same files."""
    for n in names:
        if os.path.exists(table_path(sf_dir, n)):
            read_table(spark, sf_dir, n).createOrReplaceTempView(n)
