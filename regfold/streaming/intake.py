"""Consume each landed file once, as a Structured Streaming file source.

``trigger(availableNow=True)`` processes every file present at start in bounded micro-batches and
stops; the checkpoint remembers which files were taken, so a rerun adds nothing and a new drop
adds only itself. The file sink commits batches atomically, so a lost executor or a killed run
repeats a batch without duplicating it. The source's "delete the input after success" is the
stream's optional ``cleanSource`` (archive or delete), off by default.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


PROGRESS_CONF = "spark.sql.streaming.numRecentProgressUpdates"
MAX_BATCHES = 100_000


def consume_once(spark: SparkSession, src_dir: str, schema: T.StructType, sink_dir: str, checkpoint_dir: str,
                 fmt: str = "parquet", options: dict | None = None, clean_source: str | None = None,
                 max_files_per_trigger: int | None = None, partition_by: tuple[str, ...] = ()) -> dict:
    """Run one availableNow pass from ``src_dir`` into a Parquet table at ``sink_dir``.

    Returns the number of input rows this pass took (0 when nothing new landed).
    """
    r = spark.readStream.schema(schema).format(fmt).options(**(options or {}))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if clean_source:
        r = r.option("cleanSource", clean_source)
    stream = r.load(src_dir)
    w = (stream.writeStream.format("parquet").option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    # the row count is the sum over all micro-batches, and Spark keeps the last 100 by default
    kept = spark.conf.get(PROGRESS_CONF)
    spark.conf.set(PROGRESS_CONF, MAX_BATCHES)
    try:
        q = w.start(sink_dir)
        q.awaitTermination()
    finally:
        spark.conf.set(PROGRESS_CONF, kept)
    if len(q.recentProgress) >= MAX_BATCHES:
        raise RuntimeError(f"a pass took {MAX_BATCHES} micro-batches or more: raise max_files_per_trigger")
    rows = sum(_input_rows(p) for p in q.recentProgress)
    return {"id": q.id, "batches": len(q.recentProgress), "rows": rows}


def _input_rows(p) -> int:
    return int(p["numInputRows"] if isinstance(p, dict) else p.numInputRows)


def read_sink(spark: SparkSession, sink_dir: str) -> DataFrame:
    """The sink as a table: only files committed by the stream's log are read."""
    return spark.read.parquet(sink_dir)
