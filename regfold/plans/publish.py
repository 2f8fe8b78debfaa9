"""Publishing (S11, S12, S14, S15, S16) and the run manifest.

* ``publish``: write a detail table into ``<root>/registry=<r>/table=<t>/load_date=<d>/`` with
  dynamic partition overwrite, so publishing a slice twice equals publishing it once (S6, D5).
  The source renames single files to chosen names; here the partition path is the name and
  files are bounded by ``maxRecordsPerFile`` instead of forcing one file (one task) per slice.
* ``drop_index``, ``write_drops``: the second publication as flat drop files (S15, C13).
* ``retention``, ``expire_drops``: drop files at least 21 whole days old go (S16, F3, C5, C6).
* ``manifest``: one row per published slice with files, rows, bytes and the flags the source
  passes on to the next system (N2).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regfold.functions.dates import age_days, is_expired, parse_drop_time
from regfold.functions.names import PARQUET_EXT, drop_name
from regfold.plans.fanout import slice_path, write_table
from regfold.session import ensure_checkpoint_dir
from regfold.sources.files import copy_file, delete_file
from regfold.sources.landing import file_manifest

# Flags the source passes on with its success notice (fixed values; not acted on here).
NOTICE_FLAGS = (
    ("mem_limit", 30),
    ("s3_clean_if_exist", True),
    ("format_check", True),
    ("hist", True),
    ("file_mask", [".parquet"]),
    ("destination", ["drp"]),
)


def publish(df: DataFrame, out_root: str, registry: str, table: str, load_date: Column | None = None) -> str:
    """S11 + S14: write one table's date slices; reruns replace only the slices written."""
    if "load_date" not in df.columns:
        if load_date is None:
            raise ValueError("publish needs a load_date column or expression")
        df = df.withColumn("load_date", load_date)
    write_table(df, out_root, registry, table, None)
    return slice_path(out_root, registry, table)


def read_published(spark: SparkSession, out_root: str) -> DataFrame:
    """All published slices as one table with ``registry, table, load_date`` columns."""
    return spark.read.option("basePath", out_root).parquet(out_root)


def slices(published: DataFrame, digest: Column | None = None) -> DataFrame:
    """Published slices with their rows, files and bytes (and the sum of ``digest``, a decimal as text): rows
    are counted per file first (partial aggregation), then files are summed per slice, so no file size counts twice."""
    keys = ["registry", "table", "load_date"]
    per_file = (published.groupBy(*keys, F.col("_metadata.file_path").alias("_file"))
                .agg(F.count(F.lit(1)).alias("_rows"), F.max(F.col("_metadata.file_size")).alias("_bytes"),
                     *([digest.alias("_digest")] if digest is not None else [])))
    more = [F.sum(F.col("_digest").cast("decimal(38,0)")).cast("string").alias("digest")] if digest is not None else []
    return per_file.groupBy(*keys).agg(F.sum("_rows").cast("bigint").alias("n_rows"),
                                       F.count(F.lit(1)).alias("n_files"),
                                       F.sum("_bytes").cast("bigint").alias("n_bytes"), *more)


def manifest(published: DataFrame, bucket_name: str | None = None, pilot_name: str | None = None) -> DataFrame:
    """One row per (registry, table, load_date) of published rows, or of their ``slices``, with rows, files, bytes, the
    names the caller passes on (where the slices lie, for whom) and the notice flags."""
    checked = published if "n_files" in published.columns else slices(published)
    names = [F.lit(bucket_name).cast("string").alias("bucket_name"), F.lit(pilot_name).cast("string").alias("pilot_name")]
    flags = [F.lit(v).alias(k) for k, v in NOTICE_FLAGS]
    return checked.select("registry", "table", "load_date", "n_rows", "n_files", "n_bytes",
                          *[c for c in ("digest",) if c in checked.columns], *names, *flags)


def slice_files(published: DataFrame) -> DataFrame:
    """The files of published slices, without empty ones: registry, table, load_date, path."""
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return published.select("registry", "table", "load_date", path.alias("path")).distinct()


def drop_index(files: DataFrame, run_ts: Column) -> DataFrame:
    """S15 + C13: a flat drop-file name per file (or slice): run time + its sequence in seconds.

    The sequence is a row number over the list of this run's files: a row for each, never the data,
    so one ordered task is fine.
    """
    keys = ["registry", "table", "load_date", *(["path"] if "path" in files.columns else [])]
    seq = F.row_number().over(Window.orderBy(*keys)) - 1
    return (files.select(*keys)
            .withColumn("seq", seq.cast("bigint"))
            .withColumn("drop_name", drop_name(run_ts, F.col("seq"))))


def write_drops(published: DataFrame, drop_dir: str, run_ts: Column) -> DataFrame:
    """Copy every file of the published slices into one flat folder, named by ``drop_index``.

    Executors stream the files, a row of the index each. The index is checkpointed first, so a retried
    task writes the same names; a copy lands under a hidden name and is then moved to its own, so a
    reader never sees half a file. Returns the index.
    """
    ensure_checkpoint_dir(published.sparkSession)
    index = drop_index(slice_files(published), run_ts).checkpoint()

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, name in zip(pdf["path"], pdf["drop_name"], strict=True):
                copy_file(path, f"{drop_dir.rstrip('/')}/{name}")
            yield pdf[["drop_name"]]

    copied = _spread_files(index, "drop_name").mapInPandas(copy, "drop_name STRING")
    copied.agg(F.count(F.lit(1))).collect()  # runs the copies
    return index


# Files handed to one task when copying or deleting them.
FILES_PER_TASK = 16


def _spread_files(files: DataFrame, key: str) -> DataFrame:
    """A checkpointed list of files in about one partition for each ``FILES_PER_TASK``."""
    return files.repartition(max(1, -(-files.count() // FILES_PER_TASK)), key)


def retention(drops: DataFrame, now: Column, name_col: str = "drop_name") -> DataFrame:
    """S16 + F3: parse each drop name, age it in whole days, mark it expired at >= 21 days.

    Names that do not parse are kept and flagged (the source would stop on them).
    """
    stem = F.regexp_replace(F.col(name_col), F.lit(PARQUET_EXT.replace(".", r"\.") + "$"), F.lit(""))
    ts = parse_drop_time(stem)
    return drops.select(
        "*",
        ts.alias("drop_time"),
        age_days(ts, now).alias("age_days"),
        F.coalesce(is_expired(ts, now), F.lit(False)).alias("expired"),
        ts.isNull().alias("unparsable"),
    )


def expire_drops(spark: SparkSession, drop_dir: str, now: Column, delete: bool = False) -> DataFrame:
    """The drop files in ``drop_dir`` that are expired or unparsable, as rows; with
    ``delete``, the expired ones are removed by the executors.

    The listing reads metadata only and is checkpointed before anything goes, so lost executors
    repeat nothing but deletions (a file already gone is fine). Unparsable names are never deleted.
    """
    ensure_checkpoint_dir(spark)
    listed = file_manifest(spark, drop_dir, "*" + PARQUET_EXT).select(
        F.col("file_name").alias("drop_name"), F.concat_ws("/", "dir", "file_name").alias("path"))
    rows = retention(listed, now).where("expired or unparsable").checkpoint()
    if delete:
        def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for path in pdf["path"]:
                    delete_file(path)
                yield pdf

        gone = rows.where("expired").select("path").checkpoint()
        _spread_files(gone, "path").mapInPandas(remove, "path STRING").agg(F.count(F.lit(1))).collect()
    return rows
