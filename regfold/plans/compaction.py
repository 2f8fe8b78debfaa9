"""Compaction of published slices, without a merge step in the way of readers.

Late parts, many scan tasks or small drops leave slices of many small files. ``compact`` lists the files of the current
slices (sizes only), picks the dates with a table whose files could be packed into clearly fewer of ``TARGET_BYTES``, writes these
dates anew into run folders of its own and makes them current by one commit, as a load does (``commits``): a reader
sees the old files or the new ones, and the old ones stay until a later commit.
"""

from __future__ import annotations

import os
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regfold.plans import commits
from regfold.plans.fanout import write_table

TARGET_BYTES = 256 * 1024 * 1024


def file_counts(spark: SparkSession, out_root: str, target_bytes: int = TARGET_BYTES) -> DataFrame | None:
    """(registry, table, load_date, n_files, n_bytes, n_needed) of the current slices; a row per slice, from file
    metadata alone. None if nothing is published."""
    folders = commits.slice_folders(spark, out_root, commits.current(out_root).slices)
    if not folders:
        return None
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folders).select(
        F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("path"),
        F.col("_metadata.file_size").alias("size"))
    of = {k: F.regexp_extract("path", rf"/{k}=([^/]*)/", 1).alias(k) for k in ("registry", "table", "load_date")}
    return files.groupBy(*of.values()).agg(F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("n_bytes")).withColumn(
        "n_needed", F.greatest(F.ceil(F.col("n_bytes") / target_bytes), F.lit(1)))


def compact(spark: SparkSession, out_root: str, target_bytes: int = TARGET_BYTES, parallel: int = 4) -> dict[str, list[str]]:
    """Rewrite the dates of which a table has at least twice the files it needs; returns them by register."""
    counts = file_counts(spark, out_root, target_bytes)
    if counts is None:
        return {}
    # a row per date to rewrite
    dates: dict[str, list[str]] = {}
    for r in counts.where("n_files >= 2 * n_needed").select("registry", "load_date").distinct().orderBy("registry", "load_date").collect():
        dates.setdefault(r["registry"], []).append(r["load_date"])
    if not dates:
        return {}
    state = commits.current(out_root)
    run = f"compact-{uuid.uuid4().hex[:12]}"
    tables: dict[tuple[str, str], list[str]] = {}
    for r, ds in dates.items():
        for p in commits.slice_folders(spark, out_root, {r: {d: state.slices[r][d] for d in ds}}):
            tables.setdefault((r, commits.value_in(p, "table")), []).append(p)

    def one(job) -> None:
        (registry, table), folders = job
        rows = spark.read.option("basePath", os.path.join(out_root, f"registry={registry}", f"table={table}")).parquet(*folders)
        rows = rows.drop("run").withColumn("load_date", F.col("load_date").cast("date"))
        write_table(rows, out_root, registry, table, None, run)

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        list(pool.map(one, tables.items()))
    commits.commit(out_root, state.after(run, run, dates))
    commits.vacuum(spark, out_root)
    return dates
